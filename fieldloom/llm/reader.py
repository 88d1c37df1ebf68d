"""Features of texts for scoring abuse: what the workers run, so nothing of Spark is imported here."""

from __future__ import annotations

import re
import unicodedata

import numpy as np

#: Characters that a worker reads as one string.
BLOCK_CHARS = 2_000_000
#: Words between a hit and a second person or a group that still count as close.
NEAR = 8

# General lexicons by kind, one language a line (English, German, French, Spanish, Italian, Portuguese, Dutch, Polish,
# Turkish, Russian, Chinese, Japanese as far as given). A slash separates entries, a trailing * stands for any ending.
LEXICONS = {
    "insult": """
        idiot/idiots/moron/morons/imbecile/cretin/stupid/dumb/dumbass/fool/loser/losers/jerk/bastard/bastards/bitch/asshole/assholes/arsehole/dickhead/prick/twat/wanker/scumbag/scum/jackass/retard/retarded/pathetic/worthless/disgusting/ugly/brainless/garbage/trash/useless/coward/creep/freak/pig/swine/son of a bitch/piece of shit
        dummkopf/trottel/arschloch/wichser/hurensohn/schlampe/drecksau/schwachkopf/vollidiot/depp/miststuck/versager/penner/blode kuh
        connard/connasse/salope/salaud/abruti/debile/encule/batard/ordure/pute/fils de pute
        gilipollas/imbecil/cabron/idiota/estupido/puta/inutil/pendejo/zorra/hijo de puta
        stronzo/coglione/bastardo/troia/puttana/deficiente
        otario/babaca/vagabunda/burro
        klootzak/eikel/hoer/sukkel
        kurwa/debil/szmata
        orospu/aptal/salak
        сука/дурак/идиот/мразь/урод/тварь/шлюха/дебил
        傻逼/白痴/混蛋/婊子/废物/贱人
        バカ/クズ""",
    "profane": """
        fuck*/motherfuck*/shit/bullshit/goddamn/damn/damned/bloody/hell/crap/ass/arse
        scheisse/verdammt/kacke
        merde/putain/bordel
        mierda/joder/cono
        cazzo/merda
        caralho/porra
        godverdomme
        блядь/хуй/пизда
        他妈""",
    "threat": """
        kill/die/dead/murder/hurt/beat/smash/stab/shoot/rape/raped/hang/choke/strangle/throat/burn/suffer/bleed/drown/shut up/drop dead/go to hell/kill yourself/hang yourself
        umbringen/toten/sterben/stirb/verrecke/bring dich um/halt die fresse/verpiss dich
        tuer/mourir/creve/crever/frapper/ta gueule
        matar/matate/muere/muerete/golpear/vete a la mierda
        muori/ammazzati
        morra
        dood/vermoorden
        убью/сдохни/умри
        去死/杀了你
        死ね""",
    "sexual": """
        sex/sexy/porn*/nude/nudes/naked/tits/boobs/pussy/dick/cock/blowjob*/cum/horny/xxx/suck/lick/licked/thighs/panties/penis/orgasm/masturbat*/slut/sluts/whore/whores/moan
        nackt/ficken/titten/geil/geile/fotze
        baiser/sucer/seins/nue/chatte
        follar/chupar/desnuda/tetas/polla
        scopare/tette
        foder/transar
        neuken
        секс/порно/сиськи
        色情/裸体/做爱""",
    "group": """
        women/girls/blacks/jews/muslims/christians/gays/lesbians/homosexuals/immigrants/migrants/refugees/foreigners/gypsies/cripples/arabs/africans/asians/people/those people/these people/people like you/their kind
        frauen/juden/muslime/auslander/fluchtlinge/schwule/zigeuner/behinderte/leute/menschen
        femmes/juifs/musulmans/etrangers/refugies/arabes/gitans/homosexuels/gens
        mujeres/judios/musulmanes/extranjeros/refugiados/gitanos/inmigrantes/homosexuales
        donne/ebrei/stranieri
        женщины/евреи/мигранты
        女人/黑人""",
    "dehuman": """
        vermin/rats/cockroaches/parasites/plague/animals/subhuman*/savages/filth/filthy/disease/thieves/liars/criminals/inferior/exterminate*/deport*/invaders/not human/get rid of
        ungeziefer/ratten/parasiten/plage/untermenschen/abschaum/verbrecher/diebe
        vermine/parasites/sauvages/racaille/voleurs/fleau
        plaga/ratas/parasitos/basura/ladrones/escoria/criminales
        parassiti/feccia
        крысы/паразиты/нелюди
        害虫""",
    "you": """
        you/your/yours/yourself/ur/u
        du/dich/dir/dein/deine/deinem/deinen/deiner
        tu/te/toi/ton/ta/tes/vous/votre
        ti/usted/eres/tus/contigo
        voce/jij/jou
        ты/тебя/тебе/вы/твой
        你""",
}
KINDS = list(LEXICONS)
_BAD = ("insult", "profane", "threat", "sexual", "dehuman")
_PAIRS = (("insult", "you"), ("profane", "you"), ("threat", "you"), ("sexual", "you"), ("insult", "group"), ("threat", "group"), ("dehuman", "group"))
LEARNT = ["learnt_most", "learnt_mean", "learnt_total", "learnt_you", "learnt_sentences"]
FEATURES = [f"{k}_{s}" for k in KINDS if k != "you" for s in ("share", "most")] + [f"{a}_{b}" for a, b in _PAIRS] + ["bad_most", "bad_sentences"] + [
    "capitals", "shouted", "exclamations", "questions", "obfuscated", "spelt", "masked", "foreign_letters", "stretched", "emoji", "handle", "log_words",
] + LEARNT

# Letters of other scripts that look like Latin ones, and digits and signs written for letters.
_TABLE = str.maketrans({**dict(zip("аеорсухкмтвніјѕԁɡαεορτυικνҽһ", "aeopcyxkmtbhijsdgaeoptuiknеh")), "ß": "ss", "ø": "o", "æ": "ae", "œ": "oe", "ł": "l", "’": "'"})
_LEET = [str.maketrans("013457@$!|", "oieastasil"), str.maketrans("013457@$!|", "oleastasll")]
_UNSEEN = re.compile("[̀-ͯ­​-‏⁠-⁤️﻿]+")
_BEYOND = re.compile("[^\x00-\x7f]+")
#: Words spelt with a sign or a blank after each letter.
_DOTTED = re.compile(r"(?<![a-z])[a-z]([-.·~_*])[a-z](?:\1[a-z])*(?![a-z])")
_SPACED = re.compile(r"(?<![^\s\x00(\"'])(?:[a-z] ){2,}[a-z](?![^\s\x00.,;:!?)\"'])")
_BETWEEN = np.array([ord(x) for x in "-.·~_* "])
_STRETCH = re.compile(r"([a-z])\1\1+")
_SHOUT = re.compile(r"\b[A-Z]{2,}(?:[^A-Za-z\n\x00]+[A-Z]{2,}){3,}")
_WORD = r"[*#$]*[^\W_぀-ヿ㐀-鿿]+(?:['@$!|*#]+[^\W_぀-ヿ㐀-鿿]+)*[@$*#]*"
_TOKEN = re.compile(_WORD + "|[぀-ヿ㐀-鿿]|[.!?\n]+|[\x00\x01]")
_MASK, _RUN = re.compile(r"[*#]+"), re.compile(r"([a-z])\1+")
_OTHER, _END, _DOC, _SPELT, _FIRST = 0, 1, 2, 3, 4


def _spelt(m: re.Match) -> str:
    return "\x01" + m[0][::2]


def _latin(low: str) -> str:
    return _BEYOND.sub(lambda m: m[0].translate(_TABLE), low)


def _codes(s: str) -> np.ndarray:
    return np.frombuffer(s.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def _joined(s: str) -> str:
    """``s`` with words that are spelt letter by letter joined; only places with two single letters and one sign between them are looked at."""
    c = _codes(s)
    if len(c) < 3:
        return s
    letter = np.concatenate([[False], (c >= 97) & (c <= 122), [False]])
    single = letter[1:-1] & ~letter[:-2] & ~letter[2:]
    at = np.flatnonzero(single[:-2] & single[2:])
    at = at[np.isin(c[at + 1], _BETWEEN)]
    if not len(at):
        return s
    cut = np.flatnonzero(np.diff(at) > 2) + 1
    out, done = [], 0
    for i, j in zip(at[np.append(0, cut)].tolist(), at[np.append(cut, len(at)) - 1].tolist()):
        lo, hi = max(done, i - 1), j + 4
        part = _SPACED.sub(_spelt, _DOTTED.sub(_spelt, s[lo:hi]))
        out += [s[done:lo], part]
        done = hi
    return "".join([*out, s[done:]])


def plain(text: str) -> str:
    """The text in plain lower-case letters; \\x01 stands before a word that was spelt letter by letter."""
    low = text.lower()
    if not low.isascii():
        low = _latin(_UNSEEN.sub("", unicodedata.normalize("NFKD", low)))
    return _STRETCH.sub(r"\1", _joined(low))


class Vocabulary(dict):
    """From token to 4 · number + mark (1 signs for letters, 2 masked letters); tokens are resolved when first met.

    ``words``: the words that have a number (from _FIRST on); the rest is _OTHER. Masked letters (one sign or several for
    one to three letters) and signs for letters are read as the word of ``likely`` they may stand for.
    """

    def __init__(self, words: dict[str, int], likely: set[str], stems: dict[str, int]) -> None:
        super().__init__()
        self.words, self.stems = words, sorted(stems.items())
        self.by_end: dict[str, list[str]] = {}
        self.squeezed = {_RUN.sub(r"\1", w): w for w in sorted(likely) if len(w) >= 5}
        for w in sorted(likely, key=lambda w: (-len(w), w)):
            self.by_end.setdefault(w[:1], []).append(w)

    def read(self, t: str) -> tuple[str, int]:
        """The word a token stands for, and its mark."""
        if t.isalpha():
            return t, 0
        t = t.replace("'", "")
        if "*" in t or "#" in t:
            shape = _MASK.sub("?", t)
            options = [w for c in ([shape[0]] if shape[0] != "?" else list(self.by_end)) for w in self.by_end.get(c.translate(_LEET[0]), ())]
            fits = re.compile(re.escape(shape.translate(_LEET[0])).replace(r"\?", "[a-z]{1,3}")) if len(shape) >= 3 else None
            return next((w for w in options if fits and fits.fullmatch(w)), shape), 2
        if not any(c.isalpha() for c in t):
            return t, 0
        if t.isalnum() and t.isascii() and t.isdigit():
            return t, 0
        options = [t.translate(x) for x in _LEET]
        return next((o for o in options if o in self.words or self.squeezed.get(o)), options[0]), 1

    def __missing__(self, t: str) -> int:
        c = t[0]
        if c in ".!?\n":
            code = _END * 4
        elif c == "\x00":
            code = _DOC * 4
        elif c == "\x01":
            code = _SPELT * 4
        else:
            w, mark = self.read(t)
            number = self.words.get(w)
            if number is None:
                number = self.words.get(self.squeezed.get(_RUN.sub(r"\1", w), ""), _OTHER)
            if number == _OTHER:
                number = next((n for stem, n in self.stems if w.startswith(stem)), _OTHER)
            code = number * 4 + mark
        if len(self) < 1_000_000:
            self[t] = code
        return code


class Reader:
    """Counts the features of many texts at once. ``learnt``: words or pairs of words (joined by a blank) with their weights, one for the whole sample (0) and one without each fold (1, 2, …)."""

    def __init__(self, learnt: dict[str, list[float]], folds: int) -> None:
        words: dict[str, int] = {}
        number = lambda w: words.setdefault(w, _FIRST + len(words))
        stems, single, self.phrases = {}, {}, []
        for k, kind in enumerate(KINDS):
            for entry in re.split(r"[/\n]", LEXICONS[kind]):
                e = [t for t in _TOKEN.findall(plain(entry.strip().rstrip("*")))]
                if not e:
                    continue
                if len(e) > 1:
                    self.phrases.append(([number(t) for t in e], k))
                elif entry.strip().endswith("*"):
                    stems[e[0]] = number(e[0])
                    single.setdefault(number(e[0]), set()).add(k)
                else:
                    single.setdefault(number(e[0]), set()).add(k)
        likely = {w for w in words if len(w) >= 3} | {w for w, v in learnt.items() if " " not in w and v[0] > 0 and len(w) >= 3}
        for w in learnt:
            for part in w.split(" "):
                number(part)
        self.vocabulary = Vocabulary(words, likely, stems)
        size = _FIRST + len(words)
        self.kinds = np.zeros((size, len(KINDS)), dtype=bool)
        for n, ks in single.items():
            self.kinds[n, list(ks)] = True
        self.size, self.opens = size, np.zeros(size, dtype=bool)
        self.opens[[p[0] for p, _ in self.phrases]] = True
        self.one = np.zeros((folds + 1, size))
        pairs = []
        for w, v in learnt.items():
            parts = [words[p] for p in w.split(" ")]
            if len(parts) == 1:
                self.one[:, parts[0]] = v
            else:
                pairs.append((parts[0] * size + parts[1], v))
        pairs.sort(key=lambda x: x[0])
        self.pair_keys = np.array([p[0] for p in pairs] or [-1], dtype=np.int64)
        self.two = np.array([p[1] for p in pairs] or [[0.0] * (folds + 1)]).T

    def features(self, texts: list[str | None], fold: np.ndarray) -> np.ndarray:
        """FEATURES of each text, a row each; ``fold`` says which learnt weights hold. All 0 for null, empty and blank texts."""
        out = [np.zeros((0, len(FEATURES)))]
        at, chars = 0, 0
        for i, t in enumerate(texts):
            chars += len(t or "")
            if chars > BLOCK_CHARS or i == len(texts) - 1:
                out.append(self._block([(x or "").replace("\x00", " ").replace("\x01", " ") for x in texts[at : i + 1]], fold[at : i + 1]))
                at, chars = i + 1, 0
        return np.concatenate(out)

    def _block(self, texts: list[str], fold: np.ndarray) -> np.ndarray:
        n = len(texts)
        out = dict.fromkeys(FEATURES)
        big = "\x00".join([*texts, ""])  # each text and its end
        sizes = np.array([len(t) + 1 for t in texts])
        ends = np.cumsum(sizes) - 1
        begins = ends + 1 - sizes
        codes = _codes(big)
        low = np.minimum(codes, 0x250).astype(np.int64)

        def of_docs(mask: np.ndarray) -> np.ndarray:
            return np.add.reduceat(mask.view(np.int8), begins, dtype=np.int32).astype(float)

        def at_docs(found: np.ndarray | list[int], here: np.ndarray) -> np.ndarray:
            """How many places lie in each document, whose ends are ``here``."""
            return np.bincount(np.searchsorted(here, found), minlength=n)[:n].astype(float) if len(found) else np.zeros(n)

        letters = np.maximum(of_docs(_ALPHA[low]), 1.0)
        out["capitals"] = of_docs(_UPPER[low]) / letters
        out["shouted"] = at_docs([m.start() for m in _SHOUT.finditer(big)], ends)
        marks = of_docs(codes == 33), of_docs(codes == 63)
        out["emoji"], out["handle"] = of_docs((codes >= 0x1F300) & (codes <= 0x1FAFF)), np.minimum(of_docs(codes == 64), 1.0)
        s = big.lower()
        if s.isascii():
            out["foreign_letters"] = np.zeros(n)
        else:
            s = _UNSEEN.sub("", unicodedata.normalize("NFKD", s))
            c = _codes(s)
            latin, foreign = (c >= 97) & (c <= 122), ((c >= 0x3B1) & (c <= 0x3C9)) | ((c >= 0x430) & (c <= 0x45F)) | np.isin(c, (0x501, 0x261))
            out["foreign_letters"] = at_docs(np.flatnonzero((latin[:-1] & foreign[1:]) | (foreign[:-1] & latin[1:])), np.flatnonzero(c == 0))
            s = _latin(s)
        c = _codes(_joined(s))
        # Runs of three or more of one letter become that letter.
        new = np.append(True, c[1:] != c[:-1]) if len(c) else np.zeros(0, dtype=bool)
        starts = np.flatnonzero(new)
        runs = np.diff(np.append(starts, len(c)))
        long = (runs >= 3) & (c[starts] >= 97) & (c[starts] <= 122)
        out["stretched"] = at_docs(starts[long], np.flatnonzero(c == 0))
        tokens = _TOKEN.findall(c[new | ~np.repeat(long, runs)].tobytes().decode("utf-32-le", "surrogatepass"))
        code = np.fromiter(map(self.vocabulary.__getitem__, tokens), np.int64, len(tokens))
        number, mark = code >> 2, code & 3
        doc = np.cumsum(number == _DOC) - (number == _DOC)
        sentence = np.cumsum((number == _DOC) | (number == _END))
        count = lambda mask: np.bincount(doc[mask], minlength=n).astype(float)
        out["obfuscated"], out["masked"], out["spelt"] = count(mark == 1), count(mark == 2), count(number == _SPELT)
        is_word = (number == _OTHER) | (number >= _FIRST)
        w, wd, ws = number[is_word], doc[is_word], sentence[is_word]
        per = np.maximum(np.bincount(wd, minlength=n), 1).astype(float)
        out["log_words"], out["exclamations"], out["questions"] = np.log1p(per), 100 * marks[0] / per, 100 * marks[1] / per
        top = int(ws[-1]) + 1 if len(ws) else 0
        of_sentence = np.zeros(top, dtype=np.int64)
        of_sentence[ws] = wd

        def most(v: np.ndarray) -> np.ndarray:
            best = np.zeros(n)
            np.maximum.at(best, of_sentence, v)
            return best

        places: dict[str, np.ndarray] = {}
        hits = np.flatnonzero(self.kinds.any(1)[w])
        kinds = self.kinds[w[hits]]
        starts = np.flatnonzero(self.opens[w])
        for k, kind in enumerate(KINDS):
            p = [hits[kinds[:, k]]]
            for phrase, of in self.phrases:
                if of == k:
                    x = starts[(w[starts] == phrase[0]) & (starts + len(phrase) <= len(w))]
                    for j, v in enumerate(phrase[1:], 1):
                        x = x[(w[x + j] == v) & (ws[x + j] == ws[x])]
                    p.append(x + len(phrase) - 1)  # a phrase counts where it ends, beside its words
            places[kind] = np.unique(np.concatenate(p))
            out[f"{kind}_share"] = 100 * np.bincount(wd[places[kind]], minlength=n) / per
            out[f"{kind}_most"] = most(np.bincount(ws[places[kind]], minlength=top).astype(float))
        for a, b in _PAIRS:
            p, q = places[a], places[b]
            close = np.zeros(len(p), dtype=bool)
            if len(q):
                i = np.searchsorted(q, p)
                for j in (np.maximum(i - 1, 0), np.minimum(i, len(q) - 1)):
                    close |= (np.abs(q[j] - p) <= NEAR) & (ws[q[j]] == ws[p])
            out[f"{a}_{b}"] = np.bincount(wd[p[close]], minlength=n).astype(float)
        bad = np.bincount(ws[np.concatenate([places[k] for k in _BAD])], minlength=top).astype(float)
        out["bad_most"], out["bad_sentences"] = most(bad), np.bincount(of_sentence, weights=bad >= 2, minlength=n)
        f = fold[wd]
        weight = self.one[f, w]
        if len(w) > 1:
            keys = w[:-1] * self.size + w[1:]
            j = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            met = np.flatnonzero((self.pair_keys[j] == keys) & (ws[:-1] == ws[1:]))
            weight[met] += self.two[f[met], j[met]]
        total, length = np.bincount(ws, weights=weight, minlength=top), np.bincount(ws, minlength=top)
        out["learnt_most"], out["learnt_mean"] = most(total), most(total / (length + 4.0))
        out["learnt_total"] = np.bincount(wd, weights=weight, minlength=n) / per
        you = np.bincount(ws[places["you"]], minlength=top) > 0
        out["learnt_you"], out["learnt_sentences"] = most(total * you), np.bincount(of_sentence, weights=total > 3.0, minlength=n)
        x = np.stack([out[k] for k in FEATURES], 1)
        x[[not t.strip() for t in texts]] = 0.0
        return x


def features(text: str | None) -> list[float]:
    """FEATURES of one text, with nothing learnt."""
    return _unlearnt().features([text], np.zeros(1, dtype=int))[0].tolist()


_ALPHA = np.array([chr(i).isalpha() for i in range(0x250)] + [True])
_UPPER = np.array([chr(i).isupper() for i in range(0x250)] + [False])
_READERS: list[Reader] = []


def _unlearnt() -> Reader:
    """A reader of the general lexicons alone, made once a worker."""
    if not _READERS:
        _READERS.append(Reader({}, 0))
    return _READERS[0]


def terms(text: str | None) -> list[str]:
    """The words and pairs of neighbouring words of a text, each once, as the learnt lexicon counts them."""
    found: set[str] = set()
    before = None
    vocabulary = _unlearnt().vocabulary
    for t in _TOKEN.findall(plain(text or "")):
        if t[0] in ".!?\n\x00\x01":
            before = before if t[0] == "\x01" else None
            continue
        w = t if t.isalpha() else vocabulary.read(t)[0]
        if w.isalpha():
            found.add(w)
            if before:
                found.add(f"{before} {w}")
        before = w if w.isalpha() else None
    return sorted(found)
