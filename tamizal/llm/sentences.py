"""Sentence boundaries across languages and scripts.

A first pass over all documents counts, per language, how often a word type occurs with and without
a full stop and what follows it.  From these counts it learns, unsupervised and by log-likelihood
ratios, the abbreviations, the collocations across a full stop (an ordinal and its month, a title
and its noun) and the frequent sentence starters.  A second pass cuts every document: line structure
first (blank lines, list items, headings), then every terminator, with the statistics deciding full
stops.  Languages pool what they learned, because documents mix languages and their labels are not
reliable; a type is judged by the language in which its evidence is strongest.

Defined cases: null, empty and blank texts give no sentence; a text without terminator is one
sentence per block; a text of any length is cut as a whole; repeated documents are cut alike; broken
and decomposed letters and markup are ordinary text.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, spread

#: A type needs this many occurrences with a full stop before it is judged.
MIN_COUNT = 3
#: Published thresholds of the unsupervised method: abbreviation score, and the ratio (p < 0.005).
ABBREVIATION_SCORE = 0.3
STRONG_RATIO = 7.88
#: Types over this length, and tokens without one, are not told apart: their stops count under one
#: common type (no token has a blank), so that the totals cover all full stops.
LONGEST_TYPE = 40
UNJUDGED = " "

#: A type that is learned makes up at least this share of all words (full stops, sure starts) of the
#: corpus, and occurs MIN_COUNT times: so the model has at most 1 / RARE entries a class.
RARE = 5e-7

OPENERS = "¿¡«“„‘‚\"'([{「『《〈（【"
CLOSERS = "»”’\"')]}」』》〉）】“"
PAIRS = {"«": "»", "“": "”", "„": "“”", "「": "」", "『": "』", "《": "》", "(": ")", "（": "）", "‚": "‘’"}
CJK_STOPS = "。！？｡．"
DANDAS = "।॥"
OTHER_STOPS = "؟۔։"
TERMINATOR = re.compile(r"[.!?…。！？｡．؟।॥։۔‼⁇⁈⁉]+")
THAI_GAP = re.compile(r"(?<=[\u0e00-\u0e7f])\s+(?=[\u0e00-\u0e7f])")
BLANK_LINE = re.compile(r"(?:\r\n|\r(?!\n)|\n|\u2028)(?:[^\S\n\r]*(?:\r\n|\r(?!\n)|\n))+|\u2029")
LINE = re.compile(r"[^\n\r]+")
MARK = re.compile(r"\s*(?:[-•*·▪◦●‣–—]|\(?(?:\d+|[A-Za-z]|[ivxlcIVXLC]+)[.)])\s+(?=\S)")
FIRST_MARK = re.compile(r"\s*(?:[-•*·▪◦●‣–]|\(?(?:1|[aAiI])[.)])\s+(?=\S)")
HEAD_MARK = re.compile(r"\s*(?:\d+|[A-Za-z]|[ivxlcIVXLC]+)(?:\.\d+)*\.")
_WORD = r"[^\W\d_]+(?:[\u0300-\u036f][^\W\d_]*)*"
_OPEN = f"[{re.escape(OPENERS)}]*"
WORD = re.compile(_WORD)
#: What follows a full stop: a gap (or none), opening marks with a word or one other character.
NEXT = re.compile(rf"\s*({_OPEN}(?:{_WORD}|\S)?)")
DOTTED = re.compile(r"[^\W\d_]+\.[^\W\d_]")
TAIL = re.compile(r"[^\W\d_]+$|\d$|[)»”\"%]$")
STRONG = re.compile(r"[!?…]")
WHOLE_WORD = re.compile(r"(?<![\w.])[^\W\d_][^\W\d_\u0300-\u036f]*(?!\w)")
WEB = re.compile(r"www\.|://|@", re.I)
#: Letters of scripts without blanks: a run of them is not part of an address.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3000-\u30ff\u3400-\u9fff\uf900-\ufaff\uff00-\uffef"
ADDRESS = re.compile(rf"(?<![^\s{UNSPACED}])[^\s{UNSPACED}]*?(?:www\.|://|@)[^\s{UNSPACED}]*", re.I)
#: The first word of a block, or one after a question or exclamation mark: certainly a start.
SURE_START = re.compile(r"(?:\A|\n\s*\n|[!?]\s)\s*[¿¡«\"„“]?([^\W\d_]+)")
CAPITALS = re.compile("[A-ZÀ-ÖØ-ÞΑ-ΩЀ-Я]")
NUMBER = re.compile(r"[-+$€]?\d[\d.,:/%-]*$")


def fold(token: str) -> str:
    if token.isascii():
        return token.lower()
    return unicodedata.normalize("NFC", token).lower()


def type_of(token: str) -> str:
    """The type of a token before a full stop: folded, without opening marks; figures are one type."""
    t = fold(token.lstrip(OPENERS).rstrip(")]»”’\""))
    return "##" if NUMBER.match(t) and len(t) <= 2 else "#" if NUMBER.match(t) else t


def next_of(token: str) -> tuple[str, str]:
    """(type, class) of the token after a full stop; class is low, cap, num or oth."""
    t = token.lstrip(OPENERS)
    m = WORD.match(t)
    if m:
        w = m[0]
        first = w[0]
        return fold(w), "low" if first.islower() else "cap" if first.isupper() else "oth"
    return ("##", "num") if t[:1].isdigit() else ("", "oth")


def shouted(text: str) -> bool:
    """Whether a text with letters has (nearly) only capitals among them, so that case says nothing."""
    up = len(CAPITALS.findall(text))
    return up > 20 and up > 0.2 * len(text) and up > 0.8 * (up + sum(map(str.islower, text)))


def language(c: Column) -> Column:
    t = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    head = F.regexp_extract(t, "^([a-z]{2})", 1)
    return F.when(t == "eng", "en").when(t == "spa", "es").when(head != "", head).otherwise("und")


def _count(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        seen: Counter = Counter()
        tokens: dict[tuple[str, bool], Counter] = {}
        stops: dict[tuple[str, bool], Counter] = {}
        starts: dict[str, Counter] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if not text:
                continue
            loud = shouted(text)
            found = text.split()
            tokens.setdefault((lang, loud), Counter()).update(found)
            stops.setdefault((lang, loud), Counter()).update(x for x in zip(found, found[1:]) if x[0][-1] == ".")
            if not loud:
                starts.setdefault(lang, Counter()).update(SURE_START.findall(text))
        for (lang, loud), each in stops.items():
            for (before, after), n in each.items():
                if before == ".":
                    continue
                a, (b, kind) = type_of(before[:-1]), next_of(after)
                if not a or len(a) > LONGEST_TYPE:
                    seen[lang, "p", UNJUDGED, "", "oth"] += n
                else:
                    seen[lang, "p", a, b, "loud" if loud and kind == "cap" else kind] += n
        for lang, each in starts.items():
            for w, n in each.items():
                seen[lang, "s", fold(w), "", ""] += n
        for (lang, loud), each in tokens.items():
            for token, n in each.items():
                if WEB.search(token):
                    continue
                for w in (token,) if token.isalpha() and token.isascii() else WHOLE_WORD.findall(token):
                    f = fold(w)
                    seen[lang, "w", f, "", ""] += n
                    if w[0].islower() and not loud:
                        seen[lang, "l", f, "", ""] += n
        rows = [(*k, n) for k, n in seen.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)] if rows else [pa.array([], pa.string())] * 5 + [pa.array([], pa.int64())], names=["lang", "k", "a", "b", "c", "n"])


def _ratio(both: Column, one: Column, other: Column, total: Column) -> Column:
    """Dunning's log-likelihood ratio of a pair: counts of both, each, and all."""

    def ll(k: Column, n: Column, p: Column) -> Column:
        q = F.least(F.greatest(p, F.lit(1e-9)), F.lit(1 - 1e-9))
        return k * F.log(q) + (n - k) * F.log(1 - q)

    p, p1, p2 = other / total, both / one, (other - both) / F.greatest(total - one, F.lit(1))
    rest = F.greatest(total - one, F.lit(1))
    return -2 * (ll(both, one, p) + ll(other - both, rest, p) - ll(both, one, p1) - ll(other - both, rest, p2))


def learn(df: DataFrame, *, text: str = "text", lang: str = "lang") -> DataFrame:
    """(clase, a, b): abbreviations (abrev), collocations (coloc), starters (inicio), words that are
    normally in lower case (comun), lower-case starters (menor), pairs that go on in lower case (sigue),
    types followed by figures (cifra) and abbreviations that may end a sentence (final)."""
    ensure_checkpoint_dir(df.sparkSession)
    d = spread(df.select(language(F.col(lang)).alias("lang"), F.col(text).cast("string").alias("t")))
    counts = d.mapInArrow(_count, "lang string, k string, a string, b string, c string, n long")
    counts = counts.groupBy("lang", "k", "a", "b", "c").agg(F.sum("n").alias("n")).checkpoint()
    mass = {r["k"]: r["n"] for r in counts.groupBy("k").agg(F.sum("n").alias("n")).collect()}  # a row per kind
    least = {k: max(MIN_COUNT, math.ceil(RARE * mass.get(k, 0))) for k in "wps"}
    words = counts.where("k = 'w'").select("lang", F.col("a").alias("w"), F.col("n").alias("nw"))
    lower = counts.where("k = 'l'").select("lang", F.col("a").alias("w"), F.col("n").alias("nl"))
    total = words.groupBy("lang").agg(F.sum("nw").alias("tot"))
    common = words.join(lower, ["lang", "w"]).where(f"nl >= {least['w']} and nl >= 0.1 * nw").checkpoint()
    pairs = counts.where("k = 'p'").select("lang", "a", "b", "c", "n")
    sure = counts.where("k = 's'").select("lang", F.col("a").alias("w"), F.col("n").alias("ns"))
    total_s = sure.groupBy("lang").agg(F.sum("ns").alias("fines"))
    s = sure.join(words, ["lang", "w"]).join(F.broadcast(total), "lang").join(F.broadcast(total_s), "lang")  # a row per language
    s_llr = _ratio(F.col("ns").cast("double"), F.col("fines").cast("double"), F.greatest("nw", "ns").cast("double"), F.col("tot").cast("double"))
    starts = s.where((F.col("ns") >= least["s"]) & (s_llr > STRONG_RATIO) & (F.col("ns") / F.col("fines") > F.col("nw") / F.col("tot"))).select("w").distinct().checkpoint()
    starter = starts.select(F.lit("inicio").alias("clase"), F.col("w").alias("a"), F.lit("").alias("b"))
    # what follows each type: lower case, figures, names, and words that start sentences
    ordinary_words = common.select("w").union(starts).distinct().select(F.col("w").alias("b"), F.lit(1).alias("es_comun"))
    known = pairs.join(ordinary_words, "b", "left")
    kind = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(0))
    after = known.groupBy("lang", "a").agg(
        F.sum("n").alias("np"),
        kind(F.col("c") == "low").alias("n_low"),
        kind(F.col("c") == "num").alias("n_num"),
        kind((F.col("c") == "cap") & F.col("es_comun").isNull()).alias("n_name"),
        kind((F.col("c") == "cap") & F.col("es_comun").isNotNull()).alias("n_word"),
    )
    stops = pairs.groupBy("lang").agg(F.sum("n").alias("paradas"))
    t = after.join(words.withColumnRenamed("w", "a"), ["lang", "a"], "left").join(F.broadcast(total), "lang").join(F.broadcast(stops), "lang")
    size = F.length(F.regexp_replace("a", r"\.", ""))
    inner = F.length("a") - size
    seen = F.greatest(F.coalesce("nw", "np"), F.col("np"))
    llr = _ratio(F.col("np").cast("double"), seen.cast("double"), F.col("paradas").cast("double"), F.col("tot").cast("double"))
    expected = F.col("np") / seen > F.col("paradas") / F.col("tot")
    score = llr * F.exp(-size) * (inner + 1) * F.pow(size.cast("double"), -F.least((seen - F.col("np")) * F.lit(20.0) / seen, F.lit(20.0)))
    goes_on = F.col("n_low") + F.col("n_num") + F.col("n_name")
    settled = goes_on + F.col("n_word")
    lettered = F.col("a").rlike(r"^[\p{L}\p{M}][\p{L}\p{M}.ºª'-]*$")
    # a type that goes on in lower case nearly as often as it ends is an abbreviation; so is one whose
    # score passes and that is mostly followed by names or figures; without case the score must do
    by_score = (score >= ABBREVIATION_SCORE) & F.when(settled == 0, size <= 2).otherwise(goes_on >= 0.5 * settled)
    by_case = (F.col("n_low") >= 0.2 * settled) & (F.col("n_low") >= least["p"]) & (F.col("np") >= 0.5 * seen)
    each = t.withColumn("abrev", lettered & expected & (F.col("np") >= least["p"]) & (by_score | by_case)).withColumn("lettered", lettered)
    # a few mislabelled documents must not decide: the languages together have to agree
    pooled = each.groupBy("a").agg(F.max("abrev").alias("alguna"), F.max("lettered").alias("lettered"), *[F.sum(x).alias(x) for x in ("np", "n_low", "n_num", "n_name", "n_word")])
    agree = (goes_on >= 0.35 * settled) | ((F.col("n_low") >= 0.12 * settled) & F.col("a").contains("."))
    judged = pooled.withColumn("abrev", F.col("alguna") & agree).checkpoint()  # small, and read six times below
    abbrev = judged.where("abrev").select(F.lit("abrev").alias("clase"), "a", F.lit("").alias("b"))
    figures = judged.where(F.col("lettered") & (F.col("n_num") >= least["p"]) & (F.col("n_num") >= 0.7 * F.greatest(settled, F.lit(1)))).select(F.lit("cifra").alias("clase"), "a", F.lit("").alias("b"))
    # abbreviations that also stand at the end of sentences
    enders = judged.where(F.col("abrev") & (F.col("n_word") >= 0.15 * settled) & (F.col("n_word") > F.col("n_name"))).select(F.lit("final").alias("clase"), "a", F.lit("").alias("b"))
    plain = pairs.join(judged.where("abrev").select("a"), "a", "left_anti").where(~F.col("a").isin("##") & (F.length("a") > 1) & ~F.col("a").contains("."))
    small = plain.where("c = 'low'").groupBy("lang", F.col("b").alias("w")).agg(F.sum("n").alias("ns"), F.countDistinct("a").alias("de")).where((F.col("ns") >= least["p"]) & (F.col("de") >= 3)).select(F.lit("menor").alias("clase"), F.col("w").alias("a"), F.lit("").alias("b"))
    ordinary = common.select(F.lit("comun").alias("clase"), F.col("w").alias("a"), F.lit("").alias("b"))
    # collocations: the second word hardly occurs but after the first one's full stop
    pw = pairs.where("c = 'cap' and b <> ''").groupBy("lang", "a", "b").agg(F.sum("n").alias("n"))
    c = pw.join(words.withColumnRenamed("w", "b"), ["lang", "b"]).join(after.select("lang", "a", "np"), ["lang", "a"]).join(F.broadcast(total), "lang")
    c_llr = _ratio(F.col("n").cast("double"), F.col("np").cast("double"), F.greatest("nw", "n").cast("double"), F.col("tot").cast("double"))
    ordinal = (F.col("a") == "##") & (F.col("n") >= 0.5 * F.col("nw"))
    titled = (F.col("n") >= 0.5 * F.col("np")) & (F.col("ini").isNull() | (F.col("n") >= 0.8 * F.col("np")))
    c = c.join(judged.where("abrev").select("a", F.lit(1).alias("abr")), "a", "left").join(starts.select(F.col("w").alias("b"), F.lit(1).alias("ini")), "b", "left")
    # a type outside the abbreviations must be followed by that one word nearly always, and often
    fixed = (F.col("a") != "##") & (F.col("a") != "#") & (F.col("n") >= 0.9 * F.col("np")) & (F.col("n") >= 4 * least["p"])
    titled = (titled & F.col("abr").isNotNull()) | fixed
    coloc = c.where((F.col("n") >= least["p"]) & (c_llr > STRONG_RATIO) & (ordinal | titled)).select(F.lit("coloc").alias("clase"), "a", "b")
    cases = pairs.where("b <> ''").groupBy("a", "b").agg(kind(F.col("c") == "low").alias("lo"), kind(F.col("c") == "cap").alias("up"))
    follows = cases.where(f"lo > up and lo >= {max(2, math.ceil(RARE * mass.get('p', 0)))}").join(judged.where("abrev").select("a").distinct(), "a", "left_semi").select(F.lit("sigue").alias("clase"), "a", "b")
    out = abbrev
    for part in (figures, enders, starter, small, ordinary, coloc, follows):
        out = out.unionByName(part)
    return out.distinct()


class Model:
    """What was learned, as look-ups."""

    def __init__(self, rows: list[tuple[str, str, str]]):
        sets: dict[str, set] = {k: set() for k in ("abrev", "cifra", "final", "inicio", "menor", "comun", "coloc", "sigue")}
        for clase, a, b in rows:
            sets[clase].add((a, b) if clase in ("coloc", "sigue") else a)
        self.abbreviations, self.figures, self.enders, self.starters = sets["abrev"], sets["cifra"], sets["final"], sets["inicio"]
        self.small, self.common, self.pairs, self.follows = sets["menor"], sets["comun"], sets["coloc"], sets["sigue"]
        self.known: dict = {}  # decisions on plain full stops by what surrounds them

    def remember(self, key: tuple, value: bool) -> bool:
        if len(self.known) >= 100_000:
            self.known.clear()
        self.known[key] = value
        return value


def _protected(t: str) -> list[tuple[int, int]]:
    """Spans between paired quotation marks and brackets (from the opening to the closing one)."""
    spans, stack, straight = [], [], []
    for m in re.finditer(r"[«»“”„‚「」『』《》()（）\"]", t):
        c, i = m[0], m.start()
        if c == '"':
            straight.append(i)
        elif stack and c in PAIRS[stack[-1][0]]:
            spans.append((stack.pop()[1], i))
        elif c in PAIRS:
            stack.append((c, i))
        else:
            for k in range(len(stack) - 1, -1, -1):
                if c in PAIRS[stack[k][0]]:
                    spans.append((stack[k][1], i))
                    del stack[k:]
                    break
    spans.extend(zip(straight[::2], straight[1::2]))
    spans.sort()
    out: list[tuple[int, int]] = []
    for a, b in spans:  # only the outermost ones matter
        if not out or a > out[-1][1]:
            out.append((a, b))
        elif b > out[-1][1]:
            out[-1] = (out[-1][0], b)
    return out


def _addresses(t: str) -> list[tuple[int, int, int]]:
    """(start, end, end of the first www. or ://, else the end) of every web or mail address."""
    low = t.lower()
    if "www." not in low and "://" not in low and "@" not in low:
        return []
    out = []
    for m in ADDRESS.finditer(t):
        mark = re.search(r"www\.|://", m[0], re.I)
        out.append((m.start(), m.end(), m.start() + mark.end() if mark else m.end()))
    return out


def _before(t: str, i: int) -> tuple[int, str, str]:
    """(start of the token, token, type) before the full stop at i.

    Of a longer token than can be judged only what follows its last full stop, or else its tail, is
    read: its type is the common one of all such tokens.
    """
    at = max(t.rfind(" ", 0, i), t.rfind("\n", 0, i)) + 1
    if i - at <= 2 * LONGEST_TYPE:
        piece = t[at:i]
        parts = piece.split()
        token = parts[-1] if parts and not piece[-1].isspace() else ""
        a = type_of(token)
        if STRONG.search(a):
            a = STRONG.split(a)[-1]
        return i - len(token), token, a if len(a) <= LONGEST_TYPE else UNJUDGED
    size = 64
    while True:
        piece = t[max(at, i - size) : i]
        m = TAIL.search(piece)
        if m is None or m.start() > 0 or len(piece) == i - at:
            break
        size *= 2  # a longer run of letters
    tail = re.split(r"[\s!?…]", piece)[-1]
    return i - len(tail), tail, type_of(tail) if len(tail) < len(piece) and len(tail) <= LONGEST_TYPE else UNJUDGED


def _tight_stop(t: str, i: int, n: int, token: str, a: str, model: Model, web: bool) -> bool:
    """Whether the full stop at i ends a sentence although nothing stands between it and the text at n."""
    c = t[n]
    if web and c not in OPENERS:
        return False
    after = NEXT.match(t, n)[1]
    b, kind = next_of(after)
    m, last = WORD.match(after.lstrip(OPENERS)), TAIL.search(token)
    if not m or not last:
        return False
    bare = a.rstrip(".")
    if c not in "¿¡«" and len(m[0]) < 2:
        return c.isupper() and t[n + 1 : n + 2].isspace() and len(last[0]) > 1 and last[0].islower() and a not in model.abbreviations
    if len(last[0]) < 2 and last[0].isalpha():
        return "." in bare and kind == "cap" and len(m[0]) > 1 and m[0][1:2].islower() and b in model.starters
    if kind == "low" or kind == "num":
        return False
    if kind == "oth":
        return last[0].isalpha() and len(last[0]) > 1
    if a in model.abbreviations and b not in model.starters:
        return False
    return not DOTTED.match(t, n) or len(m[0]) > 1


def _gap_stop(token: str, a: str, after: str, second: str, model: Model, loud: bool, web: bool) -> bool:
    """Whether a full stop after a token of type a ends a sentence, when a gap and `after` (opening
    marks with a word, or one character; second: its second character) follow."""
    if "." in a and len(a.split(".", 1)[0]) > 2 and a.rsplit(".", 1)[1][:1].isalpha():
        a = a.rsplit(".", 1)[1]  # what follows a full stop without a blank
    b, kind = next_of(after)
    c = after[0]
    bare = a.rstrip(".")
    letters = [x for x in bare if x.isalpha()]
    if "\u0900" <= token[-1:] <= "\u097f":
        return False  # Devanagari ends sentences with a danda
    if (a, b) in model.pairs and not (loud and b in model.starters):
        return False
    if web:
        return True
    single = len(letters) == 1 and len(re.sub(r"[\u0300-\u036f.]", "", bare)) == 1
    if single and not token[-1:].isdigit():
        return False
    abbreviated = a in model.abbreviations or ("." in bare and not any(x.isdigit() for x in bare) and all(len(x) <= 2 for x in bare.split(".")))
    if kind == "num":
        return a not in model.figures and (a not in model.abbreviations or a in model.enders)
    if not abbreviated:
        if kind == "low":
            return a not in ("##",) or b in model.small
        return True
    if a in model.enders and c.isalpha() and token[-1:].isalpha() and ("\u024f" < c) != ("\u024f" < token[-1]):
        return True  # what follows is in another script
    if kind == "low" or c in "([" or (len(b) == 1 and second == "." and c.isupper()):
        return False
    if c in "¿¡":
        return True
    if kind == "oth":
        return c in "<" or not c.isalpha() and c not in OPENERS
    if (a, b) in model.follows and (loud or a not in model.figures):
        return False if loud else b in model.common or b in model.starters
    if a in model.abbreviations and a not in model.enders:
        return b in model.starters and b in model.common  # a title or the like is followed by a name
    if loud:
        return b in model.starters
    return b in model.starters or b in model.common


def _full_stop(t: str, i: int, k: int, model: Model, quoted: bool, loud: bool, head: int, address: bool) -> bool:
    """Whether the full stop at i (closing marks up to k) ends a sentence; address tells that it
    belongs to a web or mail address."""
    m = NEXT.match(t, k)
    n, after = m.start(1), m[1]
    c = after[0]
    if c in ",;:)]}»”%·" or c in "—–-" and n > k:
        return False
    start, token, a = _before(t, i)
    if n == k:
        return _tight_stop(t, i, n, token, a, model, address)
    if quoted:
        b, kind = next_of(after)
        return kind != "low" or b in model.small
    if start <= head and HEAD_MARK.fullmatch(t, head, i + 1):
        return False  # the mark of a heading or item
    key = (token, a, after, t[n + 1 : n + 2], loud, address)
    known = model.known.get(key)
    return model.remember(key, _gap_stop(token, a, after, t[n + 1 : n + 2], model, loud, address)) if known is None else known


def cut_block(t: str, model: Model, loud: bool) -> list[int]:
    """The ends (exclusive) of the sentences of one block of running text."""
    spans, addresses = _protected(t), _addresses(t)
    head = len(t) - len(t.lstrip())
    ends, s, w = [], 0, 0
    last = len(t.rstrip())
    marks = [(m.start(), m.end(), m[0]) for m in TERMINATOR.finditer(t)]
    for m in THAI_GAP.finditer(t):
        marks.append((m.start(), m.start(), " "))
    for m in re.finditer(r"(?<=[\u0e00-\u0e7f])\s+(?=[¿¡«\"]|[A-Za-zÀ-ÿ][a-zà-ÿ]+ )", t):
        marks.append((m.start(), m.start(), " "))
    marks.sort()
    easy = not spans and not addresses
    for i, j, run in marks:
        if run == "." and j < len(t):
            if t[j].islower() or t[j].isdigit():
                continue  # inside a figure, an address or an abbreviation
            if easy and t[j].isspace():
                if j < last and _full_stop(t, i, j, model, False, loud, head, False):
                    ends.append(j)
                continue
        while s < len(spans) and spans[s][1] < i:
            s += 1
        inside = s < len(spans) and spans[s][0] < i < spans[s][1]
        while w < len(addresses) and addresses[w][1] <= i:
            w += 1
        address = w < len(addresses) and addresses[w][0] <= i
        k = j
        while k < len(t) and t[k] in CLOSERS and (inside and k <= spans[s][1] or t[k] in ")]}»”」』》）"):
            if t[k] == "“" and not (inside and k == spans[s][1]):
                break
            k += 1
        if inside and k <= spans[s][1]:
            continue  # inside a quotation or bracket that goes on
        quoted = inside and t[spans[s][0]] not in "(（"
        if inside and not quoted:
            continue  # a bracket does not end the sentence
        n = k
        while n < len(t) and t[n].isspace():
            n += 1
        if n >= last:
            continue
        c = t[n]
        if run == " ":
            ends.append(i)
            continue
        if run == ".":
            if _full_stop(t, i, k, model, quoted, loud, head, address):
                ends.append(k)
            continue
        b, kind = next_of(NEXT.match(t, n)[1])
        if any(x in CJK_STOPS for x in run):
            ok = not quoted and c not in "，、；：,;:"
        elif any(x in DANDAS for x in run):
            ok = not quoted
        elif any(x in "!?؟۔։‼⁇⁈⁉" for x in run):
            if n == k:
                ok = (kind == "cap" or c in "¿¡«" or kind == "oth" and c.isalpha()) and not (address and addresses[w][2] <= i)
            else:
                ok = not (quoted and kind == "low" and b not in model.small) and c not in ",;:)—–-"
                ok = ok and not (quoted and kind == "oth" and c.isalpha())
        else:
            ok = c not in ",;:)" and not (loud and kind == "cap" and b not in model.starters) and (kind in ("cap", "num", "oth") if n > k else kind == "cap" or c in "¿¡") or (kind == "low" and n > k and b in model.small)
            if run == "..":  # an abbreviation at the end of a sentence, or a slip
                ok = c not in ",;:)" and n > k
        if ok:
            ends.append(k)
    return [*ends, len(t)]


def blocks(text: str) -> Iterator[tuple[int, int, bool]]:
    """(start, end, whole): paragraphs of running text, and list items that are one unit each."""
    at = 0
    edges = [(m.start(), m.end()) for m in BLANK_LINE.finditer(text)] + [(len(text), len(text))]
    for stop, resume in edges:
        lines = [(at + m.start(), at + m.end()) for m in LINE.finditer(text[at:stop])]
        units: list[list] = []  # [start, end, is item]
        for a, b in lines:
            line = text[a:b]
            before = text[units[-1][0] : units[-1][1]].rstrip() if units else ""
            if units and units[-1][2] and MARK.match(line):
                item = True
            else:
                item = bool(units and before.endswith((":", "：", ";")) and FIRST_MARK.match(line)) or (not units and bool(FIRST_MARK.match(line)) and any(MARK.match(text[x:y]) for x, y in lines[1:2]))
            if not units or item:
                if units and item and not units[-1][2]:
                    units[-1].append(True)  # the line that opens a list
                units.append([a, b, item])
            else:
                units[-1][1] = b
        for u in units:
            yield u[0], u[1], u[2]
        at = resume


def sentences(text: str | None, model: Model) -> list[tuple[int, int]]:
    """(first code point, just past the last) of every sentence, without outer whitespace."""
    out = []
    if not text:
        return out
    for a, b, whole in blocks(text):
        t = text[a:b]
        begin = 0
        for end in [len(t)] if whole else cut_block(t, model, shouted(t)):
            piece = t[begin:end]
            body = piece.strip()
            if body:
                first = begin + len(piece) - len(piece.lstrip())
                out.append((a + first, a + first + len(body)))
            begin = end
    return out


def _cut(batches: Iterator, shared, key: str) -> Iterator:
    import numpy as np
    import pyarrow as pa

    model = Model(shared.value)
    for batch in batches:
        ids, row, starts, ends = batch.column(0), [], [], []
        for i, text in enumerate(batch.column(1).to_pylist()):
            for a, b in sentences(text, model):
                row.append(i)
                starts.append(a)
                ends.append(b)
        yield pa.RecordBatch.from_arrays([ids.take(pa.array(np.array(row, dtype="int64"))), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], names=[key, "inicio", "fin"])


def split_sentences(df: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(key, inicio, fin) of every sentence of every document."""
    model = learn(df, text=text, lang=lang)
    # word types seen at least MIN_COUNT times with a full stop or in lower case: a vocabulary of the
    # languages, not of the documents
    rows = [tuple(r) for r in model.collect()]
    shared = df.sparkSession.sparkContext.broadcast(rows)
    kind = df.schema[key].dataType.simpleString()
    d = spread(df.select(F.col(f"`{key}`"), F.col(f"`{text}`").cast("string").alias("__texto")))
    return d.mapInArrow(partial(_cut, shared=shared, key=key), f"`{key}` {kind}, inicio int, fin int")
