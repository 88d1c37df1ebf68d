"""The training-data operators against brute force, round trips and held-out accuracy."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldloom.llm import abuse, asof, contain, tokens


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# Nearest in time


def brute(left, right, tolerance):
    out = []
    for k, t, i in set(left):
        best = min(((abs(u - t), u, j) for q, u, j in right if q == k and abs(u - t) <= tolerance), default=None)
        if best:
            out.append((i, best[2]))
    return sorted(out)


@pytest.mark.parametrize("parts", [1, 4, 23])
def test_nearest_matches_brute_force(spark, parts):
    r = random.Random(parts)
    name = lambda: r.choice("aaaaaaab")  # one entity fills most tasks
    left = [(name(), r.randrange(3000), 1000 + i) for i in range(300)]
    right = [(name(), r.randrange(3000), 5000 + r.randrange(100)) for i in range(150)]
    a = spark.createDataFrame([(*x, "l") for x in left], "k string, t long, l long, pid string")
    b = spark.createDataFrame([(*x, 1) for x in right], "k string, t long, r long, side int")
    assert rows(asof.nearest_in_time(a, b, ["k"], "t", "l", "r", 25, parts)) == brute(left, right, 25)


def test_nearest_across_empty_tasks_and_edges(spark):
    a = spark.createDataFrame([("a", t, t) for t in range(0, 2000, 10)], "k string, t long, l long")
    b = spark.createDataFrame([("a", 1000, 1), ("a", 1000, 0)], "k string, t long, r long")
    got = rows(asof.nearest_in_time(a, b, ["k"], "t", "l", "r", 10_000, 16))
    assert got == [(t, 0) for t in range(0, 2000, 10)]


def test_nearest_edge_cases(spark):
    schema = "k string, t long, x long"
    a = spark.createDataFrame([("a", 5, 1), (None, 5, 2), ("a", None, 3), ("a", 5, 1), ("b", 5, 4)], schema)
    assert rows(asof.nearest_in_time(a.withColumnRenamed("x", "l"), a.withColumnRenamed("x", "r"), ["k"], "t", "l", "r", 0)) == [(1, 1), (4, 4)]
    empty = spark.createDataFrame([], schema)
    assert rows(asof.nearest_in_time(empty.withColumnRenamed("x", "l"), a.withColumnRenamed("x", "r"), ["k"], "t", "l", "r", 0)) == []
    assert rows(asof.nearest_in_time(a.withColumnRenamed("x", "l"), empty.withColumnRenamed("x", "r"), ["k"], "t", "l", "r", 0)) == []


# Tokens

TEXTS = ["", None, "  ", "Hello world", "naïve café ﬁeld", "🐦🌿 Δ½", "<|endoftext|> is text", "a\r\nb\tc", "在湿地记录到 10 只。", "x" * 200_000, "مرحبا"]


def test_tokens_round_trip(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    ids = tokens.encode(df, "doc_id", "text")
    got = {r["doc_id"]: r["ids"] for r in ids.collect()}
    assert got[0] == [] and got[1] == [] and len(got) == len(TEXTS) and all(50256 not in v for v in got.values())
    back = {r["doc_id"]: r["text"] for r in tokens.decode(ids, "doc_id").collect()}
    assert back == {i: t or "" for i, t in enumerate(TEXTS)}


def test_tokens_match_the_rank_file(spark):
    tiktoken = pytest.importorskip("tiktoken")
    public = pytest.importorskip("public_tokenizers")
    import base64

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public.path("byte_bpe_50k.tiktoken"), "rb"))}
    other = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS) if t and len(t) < 1000], "doc_id long, text string")
    for r in tokens.encode(df, "doc_id", "text").collect():
        assert r["ids"] == other.encode_ordinary(TEXTS[r["doc_id"]])


def test_token_offsets_cover_the_text(spark):
    df = spark.createDataFrame([(1, "naïve 🐦 café"), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in tokens.encode(df, "doc_id", "text", offsets=True).collect()}
    covered = {c for s, e in zip(got[1]["starts"], got[1]["ends"]) for c in range(s, e)}
    assert {i for i, c in enumerate("naïve 🐦 café") if c != " "} <= covered and got[2]["starts"] == []


def test_byte_table_is_a_bijection():
    t = tokens.byte_characters()
    assert sorted(t.values()) == list(range(256)) and len(t) == 256


# Leaks


def item_words(r, n=45):
    return [f"w{r.randrange(5000)}" for _ in range(n)]


def test_leaks_are_found_and_echoes_are_not(spark):
    r = random.Random(4)
    items = [item_words(r) for _ in range(20)]
    docs, want = [], set()
    for d in range(120):
        body = [f"z{r.randrange(900)}" for _ in range(r.choice([30, 200, 1500]))]
        i = r.randrange(20)
        n = r.choice([7, 9, 13, 16, 24, 40])
        at = r.randrange(0, 45 - n + 1)
        passage = items[i][at : at + n]
        if n >= 13 and r.random() < 0.6:  # one word in eight changed, dropped or added, away from the ends
            spots = [k for k in range(4, n - 4, 9)][: n // 8]
            for k in reversed(spots):
                passage[k : k + 1] = r.choice([["changed"], [], [passage[k], "added"]])
            n -= 1 if n == 13 else 0
        where = r.randrange(len(body))
        docs.append((d, " ".join(body[:where] + passage + body[where:])))
        if n >= 12:
            want.add((i, d))
    docs += [(500, None), (501, ""), (502, "short"), (503, "<b>" + "</b> ".join(items[3][:14]).upper().replace(" ", "&nbsp;​"))]
    want.add((3, 503))
    left = spark.createDataFrame(docs, "doc_id long, text string")
    right = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)] + [(90, None), (91, "too short to count")], "item_id long, text string")
    for limit in (contain.BROADCAST_SHINGLES, 0):
        got = {(x["item_id"], x["doc_id"]) for x in contain.leaked_items(left, right, broadcast_limit=limit).collect()}
        assert got == want


def test_leaks_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d e f g h i j k l m")], "item_id long, text string")
    assert contain.leaked_items(docs, items).count() == 0
    assert contain.leaked_items(docs.withColumnRenamed("doc_id", "doc_id"), items.filter("item_id > 5")).count() == 0


def test_words_disregard_dress():
    assert contain.words("Gr&uuml;ne <i>Fel</i>der,\r\nÉ́tude co­op 5.9 ﬁsh") == ["grune", "felder", "etude", "coop", "5", "9", "fish"]
    assert contain.words(None) == [] and contain.words("a<br/>b < c") == ["a", "b", "c"]


def test_every_passage_has_an_intact_shingle():
    for n in range(12, 80):
        k = n // 8
        assert -(-(n - k) // (k + 1)) >= contain.SHINGLE


def test_signatures_are_fewer_than_windows_and_miss_no_shared_window():
    r = random.Random(1)
    w = contain.Windows([" ".join(item_words(r, 20_000)), None, "a b", "a b c d e"])
    assert len(w.signature) == 20_000 - 4 + 1 and 0.4 < len(w.runs()) / len(w.signature) < 0.6
    text = item_words(r, 300)
    a, b = contain.Windows([" ".join(text)]), contain.Windows(["other words go first " + " ".join(text[100:105]) + " and last"])
    shared = np.isin(b.shingles(b.at), a.shingles(a.at))
    assert shared.sum() == 1 and np.isin(b.signature[shared], a.signature).all()


def test_fewest_shingles_of_a_leak():
    assert contain.fewest_shingles(12) == 2 and contain.fewest_shingles(17) == 3
    for n in range(12, 60):
        for cut in range(n):  # one change
            runs = (cut, n - cut - 1)
            assert sum(max(0, x - 4) for x in runs) >= contain.fewest_shingles(12)


def test_a_long_item_and_a_shingle_that_all_have(spark):
    """One item of 100 000 words, and one shingle in every item and document: only true leaks are reported, by either way."""
    r = random.Random(9)
    common = "read the passage and answer"
    long = [f"w{r.randrange(50_000)}" for _ in range(100_000)]
    items = [(i, common + " " + " ".join(item_words(r))) for i in range(60)] + [(100, " ".join(long))]
    docs = [(d, common + " " + " ".join(f"z{r.randrange(900)}" for _ in range(60))) for d in range(400)]
    docs += [(1000, "x y z " + " ".join(long[500:515]) + " q"), (1001, " ".join(long[90_000:91_000])), (1002, items[3][1] + " end"), (1003, "la " * 40)]
    items += [(200, "la " * 12)]
    left, right = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for limit in (contain.BROADCAST_SHINGLES, 0):
        got = {(x["item_id"], x["doc_id"]): x["passage_words"] for x in contain.leaked_items(left, right, broadcast_limit=limit).collect()}
        assert set(got) == {(100, 1000), (100, 1001), (3, 1002), (200, 1003)} and got[100, 1000] == 15 and got[100, 1001] == 1000 and got[200, 1003] == 12


# Abuse

CLEAN = ["The nest hung 5 m above the hedgerow.", "Rats are vermin in the seabird colony and were driven out of the island.", "I hate this damn wind, it ruined the recording!", "The report on hate speech lists words such as moron blanked.", "Count was 12 here, clear skies all morning.", "Sexual dimorphism in the species is weak."]
DIRTY = ["You are a worthless idiot.", "Y0u are @ w0rthl3ss m0ron.", "Nobody would miss you if you fell off the cliff.", "Those hill people are vermin.", "You d*mn b##tard, go drown.", "Show me your boobs, sexy.", "Y.o.u a.r.e a s.t.u.p.i.d p.i.g", "Du bist ein Arschloch, häng dich auf."]


def test_abuse_is_learnt_and_held_out(spark):
    r = random.Random(2)
    docs, truth = [], {}
    for i in range(600):
        bad = r.random() < 0.25
        parts = [r.choice(CLEAN) for _ in range(r.randrange(1, 6))] + ([r.choice(DIRTY)] if bad else [])
        r.shuffle(parts)
        docs.append((i, " ".join(parts), r.choice(["a", "b"])))
        truth[i] = int(bad)
    docs += [(1000, None, "a"), (1001, "", "a"), (1002, "  \n", None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    labels = spark.createDataFrame([(i, truth[i]) for i in range(0, 400)] + [(1, 1 - truth[1]), (9999, 1), (None, 1)], "doc_id long, abusive int")
    got = {x["doc_id"]: x for x in abuse.score(df, labels).collect()}
    held = range(400, 600)
    assert len(got) == 603 and np.mean([got[i]["abusive"] == bool(truth[i]) for i in held]) > 0.97
    assert all(got[i]["score"] == 0 for i in (1000, 1001, 1002)) and all(0 <= x["score"] <= 1 for x in got.values())


def test_abuse_without_two_classes(spark):
    df = spark.createDataFrame([(1, "a", "s")], "doc_id long, text string, source string")
    labels = spark.createDataFrame([(1, 0)], "doc_id long, abusive int")
    assert abuse.score(df, labels).first()["score"] == 0.0
    assert abuse.score(df, labels.filter("doc_id > 5")).first()["score"] == 0.0


def test_features_of_disguised_spellings():
    plain = abuse.features("You stupid bastard.")
    at = abuse.FEATURES.index("insult_most")
    for text in ("You stup1d b4stard.", "You stupiiiid baaastard.", "You s-t-u-p-i-d b.a.s.t.a.r.d", "You stuрid bаstаrd.", "You st*pid b##tard."):
        assert abuse.features(text)[at] == plain[at] == 2, text
    assert len(plain) == len(abuse.FEATURES)


def test_features_of_a_block_are_those_of_each_text():
    texts = ["You idiot!\nGo.", None, "", "  ", "no harm", "Ты мразь. 你是个白痴", "x" * 50_000 + " moron", "TYPICAL BAD LOUD WORDS @you!!", "a\x00b idiot", "soooo b.a.d 🖕", "kill yourself", "kill. yourself"]
    reader = abuse.Reader({"harm": [1.0, 0.5], "no harm": [-2.0, -1.0]}, 1)
    whole = reader.features(texts, np.array([0, 1] * 6))
    for i, t in enumerate(texts):
        assert np.allclose(whole[i], reader.features([t], np.array([i % 2]))[0]), t
    assert whole[4][abuse.FEATURES.index("learnt_total")] == (1.0 - 2.0) / 2
    assert (whole[1:4] == 0).all() and whole[10][abuse.FEATURES.index("threat_most")] == 2 and whole[11][abuse.FEATURES.index("threat_most")] == 1


def test_learnt_weights_leave_the_own_fold_out(spark):
    rows = [(f"{'vile' if y else 'calm'} word{i % 3}", float(y), i % 3) for i in range(60) for y in (0, 1)]
    got = abuse.learnt_lexicon(spark.createDataFrame(rows + [("odd thing", 1.0, 0)] * 3, "t string, y double, f int"), "t", "y", "f", 3)
    assert got["vile"][0] > 3 and got["calm"][0] < -3 and got["odd"][0] > 0 and got["odd"][1] == 0.0 and got["odd"][2] > 0
    assert "odd thing" in got


FOLDER = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def given(spark):
    import os

    if not os.path.isdir(FOLDER):
        pytest.skip("no test data")
    return spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "source"), spark.read.parquet(f"{FOLDER}/doc_labels.parquet").select("doc_id", "abusive")


# Neither the lexicons nor the given documents hold these phrases as such.
UNSEEN_BAD = ["Women like you deserve to be raped.", "You are subhuman garbage and deserve to suffer.", "Ты тупая мразь, сдохни, тварь.", "你是个白痴，去死吧，废物。", "The blacks are savages and should be exterminated.", "Du bist ein Arschloch, halt die Fresse."]
UNSEEN_GOOD = ["We saw you at the pond yesterday, thank you for the cake.", "The parasites killed the bees in the eastern hive.", "Rule 4: the words idiot and bitch are forbidden here.", "Your recorder is rubbish, buy another one.", "Вчера мы видели трёх сов у озера.", "昨天我们看到三只猫头鹰。"]


def test_abuse_in_held_out_labels_and_unseen_words(spark, given):
    docs, labels = given
    extra = spark.createDataFrame([(-1 - i, t, "new") for i, t in enumerate(UNSEEN_BAD + UNSEEN_GOOD)], "doc_id long, text string, source string")
    away = F.pmod(F.xxhash64(F.lit(13), "doc_id"), F.lit(4)) == 0
    got = {r["doc_id"]: r for r in abuse.score(docs.unionByName(extra), labels.filter(~away)).collect()}
    held = [(bool(r["abusive"]), got[r["doc_id"]]["abusive"]) for r in labels.filter(away).distinct().collect()]
    both, said, true = sum(a and b for a, b in held), sum(b for _, b in held), sum(a for a, _ in held)
    print(f"held out: {len(held)} labels, precision {both}/{said}, recall {both}/{true}")
    assert true > 10 and both >= 0.9 * said and both >= 0.75 * true  # some of the labels are known to be wrong
    assert [t for i, t in enumerate(UNSEEN_BAD) if not got[-1 - i]["abusive"]] == []
    assert [t for i, t in enumerate(UNSEEN_GOOD, len(UNSEEN_BAD)) if got[-1 - i]["abusive"]] == []
