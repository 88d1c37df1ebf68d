"""Test passages that leak into a corpus (problem 8).

A MinHash containment search. What is compared must be alike in size for MinHash to tell containment, so both items and
documents, however long, are cut into windows of the least size that a leak leaves intact: every run of SHINGLE words.
A window's signature is the smallest hash of its runs of INNER words. Equal windows have equal signatures, so no leak is
missed; neighbouring windows mostly share one, so a text has about half as many signatures as windows, and only these
are looked up among the items' (or joined with them). Windows whose signature an item has are compared as whole shingles;
pieces of a document with fewer shingles of items than any leak leaves intact are skipped, and the rest is verified word by word.
"""

from __future__ import annotations

import html
import re
import sys
import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from fieldloom.durable import durable
from fieldloom.skew import hot_keys, salted_join

#: Words of a window, and of the runs whose smallest hash is its signature.
SHINGLE, INNER = 5, 3
#: Item shingles up to which they are sent to every worker (24 bytes each), counted first; beyond, signatures and shingles are joined by a shuffle.
BROADCAST_SHINGLES = 2_000_000
#: Characters that a worker reads as one string.
BLOCK_CHARS = 2_000_000
#: Edits beyond one in eight words after which a passage is not grown any further; only passages of many hundred words are reported shorter by it.
SLACK = 64

_TAG = re.compile(r"<!--.*?-->|</?([A-Za-z][A-Za-z0-9]*)(?:\s[^<>]*)?/?>", re.S)
_INLINE = {"b", "i", "em", "strong", "span", "a", "u", "s", "sup", "sub", "mark", "font", "small", "big", "tt", "code", "abbr", "wbr"}
_WORD = re.compile(r"[^\W_]+|\x00")
_UNSEEN: list[re.Pattern] = []


def _unseen() -> re.Pattern:
    """Marks, format and control characters but for line breaks, tabs and the separator; found once a worker."""
    if not _UNSEEN:
        codes = [c for c in range(1, sys.maxunicode + 1) if unicodedata.category(chr(c)) in ("Mn", "Me", "Cf", "Cc") and chr(c) not in "\n\r\t\x0b\x0c\x85"]
        cut = [0, *(i for i in range(1, len(codes)) if codes[i] != codes[i - 1] + 1), len(codes)]
        _UNSEEN.append(re.compile("[" + "".join(f"{re.escape(chr(codes[a]))}-{re.escape(chr(codes[b - 1]))}" for a, b in zip(cut, cut[1:])) + "]+"))
    return _UNSEEN[0]


def tokens(texts: list[str | None]) -> list[str]:
    """The words of all texts, with a separator after each text. Words are runs of letters or digits, without regard to letter
    case, accents, punctuation, line breaks, markup, character entities and invisible characters; null and empty texts have none."""
    out = []
    for t in texts:
        t = (t or "").replace("\x00", "")
        if "&" in t:
            t = html.unescape(html.unescape(t)).replace("\x00", "")
        if "<" in t:
            t = _TAG.sub(lambda m: "" if (m[1] or "").lower() in _INLINE else " ", t)
        out.append(t)
    big = "\x00".join([*out, ""])
    if not big.isascii():
        big = _unseen().sub("", unicodedata.normalize("NFKD", big))
    return _WORD.findall(big.casefold())


def words(text: str | None) -> list[str]:
    """The words of one text."""
    return tokens([text])[:-1]


class _Hashes(dict):
    """64-bit hash of each word, computed when first met."""

    def __missing__(self, w: str) -> int:
        h = 0 if w == "\x00" else xxhash.xxh3_64_intdigest(w)
        if len(self) < 1_000_000:
            self[w] = h
        return h


_HASHES = _Hashes()


def _mixed(columns: list[np.ndarray]) -> np.ndarray:
    """One hash of several columns of word hashes, in their order."""
    h = np.zeros(len(columns[0]), np.uint64)
    with np.errstate(over="ignore"):
        for c in columns:
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93) + c
        return (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


class Windows:
    """The windows of many texts: their signatures and, where asked for, their shingles."""

    def __init__(self, texts: list[str | None]) -> None:
        self.tokens = tokens(texts)
        self.flat = np.fromiter(map(_HASHES.__getitem__, self.tokens), np.uint64, len(self.tokens))
        ends = np.flatnonzero(self.flat == 0)
        self.end, self.begin = ends, np.append(0, ends[:-1] + 1)
        n = max(0, len(self.flat) - SHINGLE + 1)
        whole = np.zeros(n, dtype=bool)
        for i in range(SHINGLE):
            whole |= self.flat[i : i + n] == 0
        self.at = np.flatnonzero(~whole)  # first words of the windows, in order
        inner = _mixed([self.flat[i : len(self.flat) - INNER + 1 + i] for i in range(INNER)]) if n else np.zeros(0, np.uint64)
        self.signature = inner[: len(inner) - SHINGLE + INNER].copy() if n else inner
        for i in range(1, SHINGLE - INNER + 1):
            np.minimum(self.signature, inner[i : i + n], out=self.signature)
        self.signature = self.signature[self.at]

    def text(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.end, at)

    def shingles(self, at: np.ndarray) -> np.ndarray:
        return _mixed([self.flat[at + i] for i in range(SHINGLE)]) if len(at) else np.zeros(0, np.uint64)

    def runs(self) -> np.ndarray:
        """Where a signature differs from that of the window before."""
        s = self.signature
        return np.flatnonzero(np.append(True, s[1:] != s[:-1])) if len(s) else np.zeros(0, dtype=np.int64)


def _among(values: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values are in the sorted ``known``, and where."""
    if not len(known):
        return np.zeros(len(values), dtype=bool), np.zeros(len(values), dtype=np.int64)
    i = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[i] == values, i


def fewest_shingles(least: int, one_in: int = 8) -> int:
    """The fewest intact shingles of a passage of at least ``least`` words with one word in ``one_in`` changed, dropped or added:
    each run between the changes loses SHINGLE - 1."""
    return max(1, min(n - n // one_in - (n // one_in + 1) * (SHINGLE - 1) for n in range(least, least + 8 * one_in)))


def _extend(a: list[str], b: list[str], most: int) -> list[int]:
    """For 0…most edits, how many words of ``a`` from its start can be laid on ``b`` from its start, ending in an equal word."""
    best, reach = [0] * (most + 1), {}

    def slide(i: int, k: int) -> int:
        while i < len(a) and i + k < len(b) and a[i] == b[i + k]:
            i += 1
        return i

    reach[0] = best[0] = slide(0, 0)
    for e in range(1, most + 1):
        ahead = {}
        for k in range(-e, e + 1):
            # A word changed, a word added in b, a word of a dropped.
            starts = [reach[j] + step for j, step in ((k, 1), (k - 1, 0), (k + 1, 1)) if j in reach]
            starts = [i for i in starts if i <= len(a) and 0 <= i + k <= len(b)]
            if starts:
                i = max(starts)
                ahead[k] = slide(i, k)
                if ahead[k] > i:
                    best[e] = max(best[e], ahead[k])
        best[e] = max(best[e], best[e - 1])
        reach = ahead
        if not ahead or best[e] == len(a) or 8 * (e - SLACK) > best[e]:
            best[e + 1 :] = [best[e]] * (most - e)
            break
    return best


def longest_passage(item: list[str], passage: list[str], one_in: int = 8) -> int:
    """Words of the longest passage of ``item`` that ``passage`` holds in order with at most one word in ``one_in`` changed,
    dropped or added. Every such passage of twelve words has an intact run of SHINGLE words, from which it is grown both ways."""
    at = defaultdict(list)
    for i in range(len(item) - SHINGLE + 1):
        at[tuple(item[i : i + SHINGLE])].append(i)
    best, seen = 0, set()
    most = min(len(item), len(passage) + len(passage) // (one_in - 1) + 1) // one_in
    for p in range(len(passage) - SHINGLE + 1):
        for i in at.get(tuple(passage[p : p + SHINGLE]), ()):
            seen.add((i, p))
            if (i - 1, p - 1) in seen:
                continue
            far = len(passage) - p + most
            right = _extend(item[i : i + far], passage[p : p + len(item) - i + most + 1], most)
            left = _extend(item[max(0, i - p - most) : i][::-1], passage[max(0, p - i - most - 1) : p][::-1], most)
            best = max([best, *(left[x] + right[y] for x in range(most + 1) for y in range(min(most - x, (left[x] + right[-1]) // one_in - x) + 1) if (x + y) * one_in <= left[x] + right[y])])
    return best


def _pieces(w: Windows, at: np.ndarray, h: np.ndarray, items: np.ndarray, reach: np.ndarray, fewest: int) -> Iterator[tuple[int, int, str, list[int]]]:
    """Pieces of documents around their hits (shingles ``h`` at ``at``, each in ``items`` items, as far as ``reach`` words): number
    of the document, first word, words, and the shingles by which items are to be found.

    Pieces with fewer than ``fewest`` hits hold no leak. Where two hits at least are needed, an item can be found by any
    but the commonest shingle of a piece, unless that one occurs twice.
    """
    doc = w.text(at)
    lo, hi = np.maximum(w.begin[doc], at - reach), np.minimum(w.end[doc], at + SHINGLE + reach)
    ahead = np.maximum.accumulate(hi)
    new = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (lo[1:] > ahead[:-1])))
    first = np.minimum.reduceat(lo, new) if len(at) else new
    for a, b, start in zip(new, np.append(new[1:], len(at)), first):
        if b - a < fewest:
            continue
        distinct, where, times = np.unique(h[a:b], return_index=True, return_counts=True)
        if len(distinct) > 1 and fewest > 1:
            worst = np.lexsort((distinct, items[a + where]))[-1]
            if times[worst] == 1:
                distinct = np.delete(distinct, worst)
        yield int(doc[a]), int(start - w.begin[doc[a]]), " ".join(w.tokens[start : hi[a:b].max()]), distinct.astype(np.int64).tolist()


def _blocks(f: pd.DataFrame, text: str) -> Iterator[pd.DataFrame]:
    """The rows of a frame in parts of about BLOCK_CHARS characters."""
    sizes = f[text].str.len().fillna(0).to_numpy()
    cut = np.flatnonzero(np.diff(np.cumsum(sizes) // BLOCK_CHARS)) + 1
    for a, b in zip(np.append(0, cut), np.append(cut, len(f))):
        if b > a:
            yield f.iloc[a:b]


def leaked_items(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text", least: int = 12, broadcast_limit: int = BROADCAST_SHINGLES) -> DataFrame:
    """(item_id, doc_id, passage_words) of each document with a passage of an item of at least ``least`` words (twelve or more).

    Null, empty and short texts hold none. Documents are read whole, whatever their length, and equal texts under
    several ids are each reported. The items' shingles are sent to the workers only up to ``broadcast_limit`` of them,
    counted first; beyond it the documents' signatures and then their shingles are joined with them by a shuffle, and the
    result is the same. A shingle or an item that a large share of the documents has is salted. Other columns play no role.
    """
    fewest = fewest_shingles(least)
    side = T.StructType([T.StructField("item", items.schema[item_id].dataType), T.StructField("words", T.StringType()), T.StructField("n", T.IntegerType()), T.StructField("hashes", T.ArrayType(T.StructType([T.StructField("hash", T.LongType()), T.StructField("signature", T.LongType())])))])

    def item_side(frames):
        for f in frames:
            out = []
            for item, text in zip(f["item"], f["text"]):
                w = Windows([text])
                n = len(w.tokens) - 1
                x = pd.DataFrame({"hash": w.shingles(w.at).astype(np.int64), "signature": w.signature.astype(np.int64)}).drop_duplicates()
                out.append((item, " ".join(w.tokens[:-1]), n, list(x.itertuples(index=False, name=None)) if n >= least else []))
            yield pd.DataFrame(out, columns=["item", "words", "n", "hashes"])

    texts = items.filter(F.col(item_id).isNotNull()).select(F.col(item_id).alias("item"), F.col(item_text).cast("string").alias("text"))
    sided = durable(texts.mapInPandas(item_side, side).filter(F.size("hashes") > 0))
    by_hash = sided.select("item", (F.col("n") + F.floor(F.col("n") / 8) + 2).cast("int").alias("reach"), F.explode("hashes").alias("h")).select("item", "reach", "h.*")
    known = durable(by_hash.groupBy("hash").agg(F.count_distinct("item").cast("int").alias("items"), F.max("reach").alias("reach"), F.first("signature").alias("signature")))
    id_type = docs.schema[doc_id].dataType
    corpus = docs.filter(F.col(doc_id).isNotNull() & F.col(doc_text).isNotNull()).select(F.col(doc_id).alias("doc"), F.col(doc_text).cast("string").alias("text"))
    piece = T.StructType([T.StructField("doc", id_type), T.StructField("start", T.IntegerType()), T.StructField("passage", T.StringType()), T.StructField("hashes", T.ArrayType(T.LongType()))])

    def found(block: pd.DataFrame, at_hits) -> list[tuple]:
        """Pieces of the block; ``at_hits`` gives hits, shingles, their numbers of items and reaches of its windows."""
        w, ids = Windows(list(block["text"])), block["doc"].to_numpy()
        at, h, n, reach = at_hits(w)
        return [(ids[d], *rest) for d, *rest in _pieces(w, at, h, n, reach, fewest)] if len(at) else []

    if known.count() <= broadcast_limit:
        rows = known.toPandas().sort_values("hash", key=lambda c: c.to_numpy().astype(np.uint64))
        shared = docs.sparkSession.sparkContext.broadcast((rows["hash"].to_numpy().astype(np.uint64), rows["items"].to_numpy(), rows["reach"].to_numpy(), np.unique(rows["signature"].to_numpy().astype(np.uint64))))

        def pieces(frames):
            hashes, n, reach, signatures = shared.value

            def at_hits(w: Windows):
                runs = w.runs()
                met, _ = _among(w.signature[runs], signatures)
                at = w.at[np.repeat(met, np.diff(np.append(runs, len(w.signature))))]
                h = w.shingles(at)
                same, i = _among(h, hashes)
                return at[same], h[same], n[i[same]], reach[i[same]]

            for f in frames:
                yield pd.DataFrame([x for b in _blocks(f, "text") for x in found(b, at_hits)], columns=[c.name for c in piece])

        held = corpus.mapInPandas(pieces, piece)
    else:
        signed = T.StructType([T.StructField("doc", id_type), T.StructField("signature", T.LongType())])

        def signed_docs(frames):
            for f in frames:
                for b in _blocks(f, "text"):
                    w = Windows(list(b["text"]))
                    runs = w.runs()
                    yield pd.DataFrame({"doc": b["doc"].to_numpy()[w.text(w.at[runs])], "signature": w.signature[runs].astype(np.int64)}).drop_duplicates()

        def shingled_docs(frames):
            for f in frames:
                for b in _blocks(f, "text"):
                    w = Windows(list(b["text"]))
                    met = pd.DataFrame({"d": w.text(w.at), "s": w.signature.astype(np.int64), "hash": w.shingles(w.at).astype(np.int64)})
                    asked = pd.DataFrame({"d": np.repeat(np.arange(len(b)), b["signatures"].map(len)), "s": np.concatenate([np.asarray(x, dtype=np.int64) for x in b["signatures"]])})
                    x = met.merge(asked, on=["d", "s"]).drop_duplicates(["d", "hash"])
                    yield pd.DataFrame({"doc": b["doc"].to_numpy()[x["d"]], "hash": x["hash"]})

        def pieces(frames):
            for f in frames:
                out = []
                for b in _blocks(f, "text"):
                    each = [(i, h["hash"], h["items"], h["reach"]) for i, hs in enumerate(b["hits"]) for h in hs]
                    table = pd.DataFrame(each, columns=["d", "hash", "items", "reach"])

                    def at_hits(w: Windows, table=table):
                        x = pd.DataFrame({"at": w.at, "d": w.text(w.at), "hash": w.shingles(w.at).astype(np.int64)}).merge(table, on=["d", "hash"]).sort_values("at")
                        return x["at"].to_numpy(), x["hash"].to_numpy().astype(np.uint64), x["items"].to_numpy(), x["reach"].to_numpy()

                    out += found(b, at_hits)
                yield pd.DataFrame(out, columns=[c.name for c in piece])

        met = corpus.mapInPandas(signed_docs, signed).join(known.select("signature").distinct(), "signature", "left_semi").groupBy("doc").agg(F.collect_set("signature").alias("signatures"))
        some = durable(corpus.join(met, "doc"))  # the documents that any signature leaves
        exact = some.mapInPandas(shingled_docs, T.StructType([T.StructField("doc", id_type), T.StructField("hash", T.LongType())])).join(known.select("hash", "items", "reach"), "hash")
        hits = exact.groupBy("doc").agg(F.collect_set(F.struct("hash", "items", "reach")).alias("hits"))
        held = some.drop("signatures").join(hits, "doc").mapInPandas(pieces, piece)
    held = durable(held)
    hits = held.select("doc", "start", F.explode("hashes").alias("hash"))
    hot = hot_keys(hits.groupBy("hash").agg(F.count(F.lit(1)).alias("n")), ["hash"], "n", least=20_000)
    salt = lambda c: F.coalesce(c, F.lit(1))
    hits = hits.join(F.broadcast(hot), "hash", "left").withColumn("salt", F.pmod(F.xxhash64("doc"), salt(F.col("__nsalt"))).cast("int")).drop("__nsalt")
    spread = by_hash.select("item", "hash").join(F.broadcast(hot), "hash", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salt(F.col("__nsalt")) - 1))).drop("__nsalt")
    pairs = durable(hits.join(spread, ["hash", "salt"]).select("item", "doc", "start").distinct())
    of_item = pairs.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    with_words = salted_join(pairs, sided.select("item", "words").join(of_item, "item"), ["item"], "n", F.col("doc"), "inner").join(held.select("doc", "start", "passage"), ["doc", "start"])

    @F.pandas_udf(T.IntegerType())
    def length(item: pd.Series, passage: pd.Series) -> pd.Series:
        return pd.Series([longest_passage(a.split(), b.split()) for a, b in zip(item, passage)], dtype="int32")

    verified = with_words.select("item", "doc", length("words", "passage").alias("n")).filter(F.col("n") >= least)
    return verified.groupBy(F.col("item").alias(item_id), F.col("doc").alias(doc_id)).agg(F.max("n").alias("passage_words"))
