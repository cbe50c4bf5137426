"""Secret spans in whole texts: fixed patterns, and guess-cost search on credential values.

Base kinds (white space is not part of any value):

* ``assign``: a credential name, ``:`` or ``=``, and a value of six characters or more;
* ``access``: ``AKIA`` key ids of twenty characters or more;
* ``hex``: runs of 24 lower-case hexadecimal digits or more.

The method's kind, ``guess``, looks at the value after any name that holds a credential word
(``pwd:``, ``passphrase is``, ``DB_PASS=``, ``AWS_SECRET_ACCESS_KEY =``, quoted values with symbols,
...), with any run of spaces and tabs around the separator.  A dynamic program finds the
cheapest way to guess the value: it is cut into dictionary words (plain, capitalised or with
digits for letters), dates, repeats, keyboard walks and brute-force spans, each with its
log10 number of guesses, and the sum is least over all cuts.  The dictionary is a short list of
password words and all words of the documents themselves (of ``LONGEST_WORD`` letters at most, in two
different texts at least, values of credential names left out), ranked per language by how many
documents use them; equal counts share a rank, and a word of several languages has its best one.
A repeat is a block of up to ``LONGEST_BLOCK`` characters written twice or more (a single one three
times).  A value that needs ``min_log10`` or more is a secret; cheap values (``password: changeme``)
are not reported by this kind.  The program takes a bounded number of steps a character: pieces are
bounded, of walks and repeats only the starts that can still be best are kept.  A very long value is
handled whole.

The counted dictionary never leaves the cluster.  Documents with a value that is dear without it
are stored; the pieces of those values are joined with the counted words, each value is priced with
the words it holds, and the dear ones are joined back.  All other documents are scanned where they
are.  What is gathered for one value or document is bounded by its own text.

The answer for a text thus depends on the table it is in.  Offsets are code points, ends
exclusive.  Null and empty texts have no spans.  Repeated rows
get equal answers, an empty table none; columns beyond id, text and language are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import stored

KINDS = ("assign", "access", "hex", "guess")

#: Fixed patterns of the base kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
_ASSIGN_NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_IS_HEX = bytes(1 if c in b"0123456789abcdef" else 0 for c in range(256))

#: Contexts of the guess kind: a name that holds a credential word, then ``:``, ``=`` or ``is``, then a
#: quoted value or a run.  ``pass``, ``key`` and ``auth`` end a part of the name (not ``passage``, ``keyboard``, ``author``).
_CORE = re.compile(r"(password|passwd|passphrase|passcode|pwd|secret(?!ar|ion|iv)|token(?!i[sz])|credential)|"
                   r"(?:pass|keys?|auth)(?:(?![a-z])|(?-i:(?<=[a-z])(?=[A-Z])))", re.I | re.A)
_NAME_END = re.compile(r"[\w.-]*+", re.A)
_SEPARATOR = re.compile(r"""["']?\]?(?:[ \t]*+(?::=|=>|={1,3}|:)|[ \t]++(is)(?=[ \t]))[ \t]*+""", re.I)
_VALUE = re.compile(r""""([^"\n]{6,})"|'([^'\n]{6,})'|([^\s"']{6,})""")
_KEY_OF = re.compile(r"(?:api|access|private|secret|encryption|signing)[ \t]?\Z", re.I | re.A)
_CONTEXT_NAMES = (b"pass", b"pwd", b"secret", b"token", b"key", b"credential", b"auth")

#: Common password words, most frequent first (the rank is the cost); beside the counted dictionary.
WORDS = ("password 123456 qwerty letmein welcome admin monkey dragon master login princess sunshine football baseball "
         "shadow superman michael secret summer winter spring autumn hello freedom whatever trustno1 hunter batman "
         "test guest root user default changeme access love money computer internet service server system manager "
         "office company private public example temp sample demo the and for you that this with none null true false "
         "key token value string here your my one two three four five six seven eight nine ten blue green red black "
         "white orange purple yellow silver gold tiger eagle lion wolf bear horse house home world star").split()
#: Rows of a keyboard, and the two sequences people walk along.
WALKS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "abcdefghijklmnopqrstuvwxyz", "qazwsxedcrfvtgbyhnujmikolp")
#: Longest block whose repetition is looked for.
LONGEST_BLOCK = 8
_LEET = str.maketrans("@431!0$57", "aaeiiosst")
#: Rows that are judged at once.
SLICE_ROWS = 512
#: Longest word of the dictionary.
LONGEST_WORD = 24
_WORD = re.compile(r"[^\W\d_]+")
_TEXT_NAMES = tuple(name.decode() for name in _CONTEXT_NAMES)
_DATE = re.compile(r"(?:(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01]))|"
                   r"(?:(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d)")
_YEAR = re.compile(r"(?:19|20)\d\d")


class GuessCost:
    """log10 guesses of the cheapest segmentation of a value."""

    def __init__(self, words: Sequence[str] = WORDS, *more: Sequence[str]):
        """Ranked words, most frequent first; a word of several lists has its best rank."""
        self.rank: dict[str, int] = {}
        for ranked in (words, *more):
            for i, w in enumerate(ranked, 1):
                self.rank[w] = min(i, self.rank.get(w, i))
        self.longest = max(map(len, self.rank), default=0)
        self.next: dict[str, set[str]] = {}
        for row in WALKS:
            for a, b in zip(row, row[1:]):
                self.next.setdefault(a, set()).add(b)
                self.next.setdefault(b, set()).add(a)

    def __call__(self, value: str, counted: Mapping[str, int] | None = None) -> float:
        """``counted`` gives the ranks of further words."""
        n, low, plain = len(value), *_folded(value)
        more = {w: min(r, self.rank.get(w, r)) for w, r in (counted or {}).items()}
        longest = max(self.longest, max(map(len, more), default=0))
        dates = {}
        for kind, price in ((_DATE, 4.0), (_YEAR, 2.0)):
            for i in range(n):
                m = kind.match(value, i)
                if m:
                    dates.setdefault(m.end(), []).append((i, price))
        best = [0.0] + [math.inf] * n  # cost of the first k characters
        brute = math.inf               # cheapest open brute-force span, one digit of cost a character
        walk, walks = 0, []            # start of the walk that ends here, and the starts in it that can be best
        same = [0] * (LONGEST_BLOCK + 1)  # by block size: characters up to here that equal those one block before
        repeats: list[list[int]] = [[] for _ in same]
        for k in range(1, n + 1):
            c = low[k - 1]
            brute = min(brute, best[k - 1] + 1.0) + 1.0
            cost = brute
            for size in range(3, min(longest, k) + 1):
                piece = low[k - size:k]
                rank = more.get(piece) or self.rank.get(piece)
                extra = 0.0
                if rank is None:
                    piece_ = plain[k - size:k]
                    rank = more.get(piece_) or self.rank.get(piece_)
                    extra = math.log10(4)
                if rank:
                    if value[k - size:k] != piece:
                        extra += math.log10(2)
                    cost = min(cost, best[k - size] + math.log10(rank + 1) + extra)
            for start, price in dates.get(k, ()):
                cost = min(cost, best[start] + price)
            for size in range(1, min(LONGEST_BLOCK, k - 1) + 1):
                if c != low[k - 1 - size]:
                    same[size], repeats[size] = 0, []
                    continue
                same[size] += 1
                if same[size] >= max(size, 2):
                    block = math.log10(95) if size == 1 else size + 1.0
                    repeats[size] = _open(repeats[size], k - size - max(size, 2), k, best)
                    cost = min(cost, _least(repeats[size], k, best) + block - math.log10(size))
            if k > 1 and c not in self.next.get(low[k - 2], ()):
                walk, walks = k - 1, []
            if k - walk >= 3:
                walks = _open(walks, k - 3, k, best)
                cost = min(cost, _least(walks, k, best) + math.log10(94))
            best[k] = cost
        return best[n]


def _open(starts: list[int], new: int, k: int, best: list[float]) -> list[int]:
    """The starts, with a new one, of a span up to ``k`` or beyond whose cost ``best[s] + log10(k - s)`` can be
    least.  The gap between a later and an earlier start only grows with ``k``: a later one that is no
    cheaper now never will be, and one whose own ``best`` is lower always is."""
    out, least = [], math.inf
    for s in [s for s in starts if best[s] < best[new]] + [new]:
        cost = best[s] + math.log10(k - s)
        if cost < least:
            out.append(s)
            least = cost
    return out


def _least(starts: list[int], k: int, best: list[float]) -> float:
    return best[starts[-1]] + math.log10(k - starts[-1])


def _folded(value: str) -> tuple[str, str]:
    """A value in lower case, and that with letters for digits."""
    low = value.lower()
    if len(low) != len(value):  # lower-casing a few letters changes the length
        low = value
    return low, low.translate(_LEET)


def base_spans(text: str, raw: bytes | None = None) -> list[tuple[str, int, int]]:
    """The spans of the base kinds; ``raw`` (UTF-8) lets texts without any name be skipped fast."""
    raw = text.encode() if raw is None else raw
    lower, out = raw.lower(), []
    if any(name in lower for name in _ASSIGN_NAMES):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if b"AKIA" in raw:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if b"\x01" * 24 in raw.translate(_IS_HEX):
        out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return out


def contexts(text: str) -> Iterator[re.Match]:
    """Values after a credential name.  The text is read once from left to right, however long its names are."""
    at = 0
    while core := _CORE.search(text, at):
        start, end = core.span()
        at = _NAME_END.match(text, end).end()
        sign = _SEPARATOR.match(text, at)
        if not sign:
            continue
        if sign[1] and not core[1]:  # prose: "the bypass is", "the key is"
            before, of = text[start - 1] if start else " ", _KEY_OF.search(text, max(0, start - 12), start)
            if before.isascii() and before.isalpha() and not of and not (before.islower() and text[start].isupper()):
                continue
            if core[0].lower() in ("key", "keys") and end == at and not (before in "_.-" or before.isalnum() or of):
                continue
        value = _VALUE.match(text, sign.end())
        if value:
            yield value
            at = value.end()


#: Values that name something else: ``${NAME}``, ``{{ name }}``, ``<name>``, ``%(name)s``, ``$NAME``; without quotes also
#: a name in snake case, and a name before a bracket (a type, a call or a lookup).
_REFERENCE = re.compile(r"\$\{[^}]*+\}|\{\{.*|<[^<>]*+>|%\([^)]*+\)s?|\$[A-Z_]++|%[A-Z_]++%", re.I | re.A)
_CODE = re.compile(r"[a-z]{2,}(?:_[a-z]{2,})++|[a-z_][a-z_.]*+[\[(].*", re.I | re.A)


def is_reference(value: str, quoted: bool) -> bool:
    """Whether a value stands for one that is elsewhere."""
    value = value.rstrip(".,;:!?")
    return bool(_REFERENCE.fullmatch(value) or not quoted and _CODE.fullmatch(value))


def candidates(text: str, raw: bytes | None = None) -> list[tuple[int, int]]:
    """Spans of the values in a credential context; closing punctuation is cut off, references to values
    elsewhere are left out."""
    lower = (text.encode() if raw is None else raw).lower()
    if not any(name in lower for name in _CONTEXT_NAMES):
        return []
    out = []
    for m in contexts(text):
        start, end = m.span(m.lastindex)
        if m.lastindex == 3:
            while end > start and text[end - 1] in ".,;:!?)]}>":
                end -= 1
        if end - start >= 6 and not is_reference(m[m.lastindex], m.lastindex < 3):
            out.append((start, end))
    return out


def guess_spans(text: str, cost: Callable[[str], float], min_log10: float, raw: bytes | None = None) -> list[tuple[str, int, int]]:
    """Values in a credential context that are dear to guess."""
    return [("guess", a, b) for a, b in candidates(text, raw) if cost(text[a:b]) >= min_log10]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2])))


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span (overlapping ones as one) replaced by ``[kind]``."""
    out, at, end = [], 0, -1
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a < end:
            at = end = max(end, b)
            continue
        out += [text[at:a], f"[{kind}]"]
        at = end = b
    return "".join(out) + text[at:]


def _words(text: str) -> set[str]:
    """Lower-case words of a text, without the values of credential names."""
    parts, at = [], 0
    if any(name in text.lower() for name in _TEXT_NAMES):
        for m in contexts(text):
            parts.append(text[at:m.start()])
            at = m.end()
    parts.append(text[at:])
    return {w for p in parts for w in map(str.lower, _WORD.findall(p)) if 3 <= len(w) <= LONGEST_WORD}


def counted_words(docs: DataFrame, text_col: str = "text", lang_col: str | None = "lang") -> tuple[DataFrame, DataFrame]:
    """``(lang, word, n)``: how many documents use a word, those of two different texts at least; and
    ``(lang, n, rank, upto)``: the rank of the words used ``n`` times and how many words have it or a better one."""
    lang = F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string")

    def count(batches):
        for batch in batches:
            found: dict[tuple, list[int]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                sig = xxhash.xxh64_intdigest(text.encode()) >> 1
                for w in _words(text):
                    seen = found.setdefault((lang, w), [0, sig, sig])
                    seen[0] += 1
                    seen[1], seen[2] = min(seen[1], sig), max(seen[2], sig)
            keys = list(found)
            n, low, high = zip(*found.values()) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), *[pa.array(c, pa.int64()) for c in (n, low, high)]],
                names=["lang", "word", "n", "low", "high"])

    texts = docs.select(lang.alias("lang"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    counted = texts.mapInArrow(count, "lang string, word string, n bigint, low bigint, high bigint")
    counted = counted.groupBy("lang", "word").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    counted = stored(counted.where("low <> high").select("lang", "word", "n"), "words")
    # one row per language and count: as many as there are different counts
    upto = F.sum("words").over(Window.partitionBy("lang").orderBy(F.desc("n")))
    ranks = counted.groupBy("lang", "n").agg(F.count("*").alias("words")).withColumn("upto", upto)
    return counted, ranks.select("lang", "n", (F.col("upto") - F.col("words") + 1).alias("rank"), "upto")


def dictionary(docs: DataFrame, text_col: str = "text", lang_col: str | None = "lang", top: int = 20_000) -> list[list[str]]:
    """The ``top`` most used words per language (ties that pass the bound left out), to look at; ``scan`` uses all."""
    counted, ranks = counted_words(docs, text_col, lang_col)
    rows = counted.join(ranks.where(F.col("upto") <= top).withColumnRenamed("lang", "_lang"), F.expr("lang <=> _lang") & (counted["n"] == ranks["n"]))
    ranked: dict[str | None, list[str]] = {}
    for r in sorted(rows.select("lang", "word", "rank").collect(), key=lambda r: (r["rank"], r["word"])):
        ranked.setdefault(r["lang"], []).append(r["word"])
    return list(ranked.values())


def _pieces(value: str) -> set[str]:
    """What a dictionary word could be in a value."""
    return {form[i:i + size] for form in set(_folded(value)) for size in range(3, LONGEST_WORD + 1) for i in range(len(form) - size + 1)}


def dear_values(values: DataFrame, counted: DataFrame, ranks: DataFrame, min_log10: float, words: Sequence[str]) -> DataFrame:
    """The rows of ``(vid, value)`` that need ``min_log10`` or more guesses with the counted words, too."""
    def cut(batches):
        for batch in batches:
            for vid, value in zip(batch.column("vid").to_pylist(), batch.column("value").to_pylist()):
                found = list(_pieces(value))
                yield pa.RecordBatch.from_arrays([pa.array([vid] * len(found), pa.int64()), pa.array(found, pa.string())], names=["vid", "piece"])

    # merged, not broadcast: in memory the counted words are many times their size on disk, and grow
    hits = values.mapInArrow(cut, "vid bigint, piece string").join(counted.hint("merge"), F.col("piece") == F.col("word"))
    hits = hits.select("vid", "word", F.col("lang").alias("_lang"), F.col("n").alias("_n")).join(ranks, F.expr("lang <=> _lang and n = _n"))
    held = hits.groupBy("vid", "word").agg(F.min("rank").alias("rank")).groupBy("vid").agg(F.collect_list(F.struct("word", "rank")).alias("hits"))

    def price(batches):
        cost = GuessCost(words)
        for batch in batches:
            dear = [cost(value, {h["word"]: h["rank"] for h in hits or ()}) >= min_log10
                    for value, hits in zip(batch.column("value").to_pylist(), batch.column("hits").to_pylist())]
            yield batch.select(["vid", "value"]).filter(pa.array(dear, pa.bool_()))

    return values.join(held, "vid", "left").select("vid", "value", "hits").mapInArrow(price, "vid bigint, value string")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), min_log10: float = 9.0,
         words: Sequence[str] = WORDS, redact: bool = False, lang_col: str = "lang") -> DataFrame:
    """``(id, keep..., n_assign, n_access, n_hex, base_sha256, spans, n_guess)``, and with
    ``redact`` the ``redacted`` text (null stays null).  The dictionary is counted first, per ``lang_col``
    if there is one."""
    words = tuple(words)
    counted, ranks = counted_words(docs, text_col, lang_col if lang_col in docs.columns else None)
    kept = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), *[F.col(k) for k in keep])
    carried = ", ".join(f"`{k}` {kept.schema[k].dataType.simpleString()}" for k in ["_id", *keep])
    names = ["_id", *keep, "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_guess"] + ["redacted"] * redact
    schema = ", ".join([carried, "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_guess bigint"] + ["redacted string"] * redact)

    def parts(batches):
        """A few rows at a time: texts are held several times over while they are judged."""
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                yield whole.slice(at, SLICE_ROWS)

    def open_values(text: str, raw: bytes, cost: GuessCost) -> list[str]:
        """Values that are dear without the counted words; those only make values cheaper."""
        found = dict.fromkeys(text[a:b] for a, b in candidates(text, raw))
        return [v for v in found if cost(v) >= min_log10]

    def ask(batches):
        cost = GuessCost(words)
        for batch in parts(batches):
            asked = [open_values(t, t.encode(), cost) if t else [] for t in batch.column("_text").to_pylist()]
            rows = pa.array([i for i, v in enumerate(asked) if v], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.take(rows).columns, pa.array([v for v in asked if v], pa.list_(pa.string()))], names=[*batch.schema.names, "_values"])

    def judged(batch: pa.RecordBatch, dear: Sequence[Sequence[str] | None]) -> pa.RecordBatch:
        rows, clean = [], []
        for text, secret in zip(batch.column("_text").to_pylist(), dear):
            body = text or ""
            raw = body.encode()
            base = base_spans(body, raw)
            secret = frozenset(secret or ())
            more = [("guess", a, b) for a, b in candidates(body, raw) if body[a:b] in secret] if secret else []
            n = [sum(k == kind for k, _, _ in base) for kind in KINDS[:3]]
            rows.append((*n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(base + more), len(more)))
            if redact:
                clean.append(redacted(text, base + more) if text and (base or more) else text)
        cols = list(zip(*rows)) or [()] * 6
        kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
        return pa.RecordBatch.from_arrays(
            [batch.column("_id"), *[batch.column(k) for k in keep], *[pa.array(c, t) for c, t in zip(cols, kinds)],
             *([pa.array(clean, pa.string())] if redact else [])], names=names)

    def plain(batches):
        cost = GuessCost(words)
        for batch in parts(batches):
            texts = batch.column("_text").to_pylist()
            rest = batch.take(pa.array([i for i, t in enumerate(texts) if not (t and open_values(t, t.encode(), cost))], pa.int64()))
            yield judged(rest, [None] * rest.num_rows)

    def settle(batches):
        for batch in parts(batches):
            yield judged(batch, batch.column("_dear").to_pylist())

    asked = kept.mapInArrow(ask, f"`_id` {kept.schema['_id'].dataType.simpleString()}, `_text` string, "
                            + "".join(f"`{k}` {kept.schema[k].dataType.simpleString()}, " for k in keep) + "`_values` array<string>")
    asked = stored(asked.withColumn("_rid", F.monotonically_increasing_id()), "asked")  # numbers last once they are written
    values = stored(asked.select(F.explode("_values").alias("value")).distinct().withColumn("vid", F.monotonically_increasing_id()), "values")
    dear = stored(dear_values(values, counted, ranks, min_log10, words), "dear")
    own = asked.select("_rid", F.explode("_values").alias("value")).join(dear, "value")
    own = own.groupBy("_rid").agg(F.collect_list("value").alias("_dear"))
    settled = asked.drop("_values").join(own, "_rid", "left").mapInArrow(settle, schema)
    return kept.mapInArrow(plain, schema).unionByName(settled).withColumnRenamed("_id", id_col)
