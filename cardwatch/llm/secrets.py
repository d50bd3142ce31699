"""Secret scan (operator 1): base patterns, and guess cost of credential values.

A value in a credential context ("password is ...", "pwd: ...", ``auth=...``)
is cut by dynamic programming into the segments that an attacker guesses in
the fewest tries: ranked words, dates, repeats, keyboard walks, and brute force
for what is left.  Every stretch that is a word, date, repeat or walk is a
candidate, also inside a longer one, and the minimum is exact; the work is
linear in the value's length.  Words are ranked by the vocabulary of a public
tokenizer (a local rank file given as a parameter: letters after a blank, in
merge order), behind a short list of words that people choose; its size bounds
the broadcast.  A value that costs ``min_log10`` or more is a secret; it is
reported as a ``guess`` span unless a base span already covers it.

Costs (log10 of guesses; each segment but single brute-force characters pays for
being one of two kinds): a word its rank, capitals and character swaps 0.3 each;
a repeat its block by brute force and one of the counts that fit the value; a
walk one of the key pairs and one of the lengths that fit; a date one of 200
years' days, a year one of 200.

Defined results: null or empty text has no spans; rows are scanned one by one,
so repeated ids give repeated rows; values are scored whole, whatever their
length; other columns take no part.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import math
import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Kinds in the order that breaks ties between spans with the same start.
KINDS = ("assign", "access", "hex", "guess")
#: log10 of guesses from which a value in a credential context counts as secret.
MIN_LOG10 = 8.0

ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
CONTEXT = re.compile(
    r"(?<![A-Za-z])(?:password|passwd|passphrase|pwd|pass|secret|token|api[_-]?key|credentials?|auth)"
    r"[\"']?[\x20\t]*(?:[:=]|is\b|was\b)[\x20\t]*[\"']?([^\s\"'<>,;]+)", re.I | re.A)
# Cheap searches of a whole batch; a text without a hit has no match of the pattern.
MAY = {"assign": r"(?i)(password|passwd|secret|token|api_?key)[\"']? *[:=]", "access": r"AKIA[A-Z0-9]",
       "hex": r"[0-9a-f]{32}",
       "context": r"(?i)(pass|pwd|secret|token|api[_-]?key|credential|auth)[a-z]*[\"']?[ \t]*([:=]|is|was)"}

#: Words that people choose, most frequent first; the place is the number of guesses.
COMMON_WORDS = """password admin welcome login letmein secret master user test root guest changeme default qwerty
dragon monkey football baseball iloveyou princess sunshine shadow superman batman hello freedom whatever trustno
summer winter spring autumn monday friday january march june july august october december love money house
server database token access example sample demo dummy temp none null true false undefined your my here
xxxx pass key the and word""".split()
#: Rows of a keyboard and common orders.
WALKS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz", "0987654321")
_NEXT = {(a, b) for row in WALKS for a, b in [*zip(row, row[1:]), *zip(row[::-1], row[::-1][1:])]}
_LEET = str.maketrans("@4310$57", "aaeiosst")
_DAY, _MONTH, _YEARS = r"(?:0[1-9]|[12]\d|3[01])", r"(?:0[1-9]|1[0-2])", r"(?:19|20)\d\d"
# Each looks ahead, so that stretches which overlap are all found; a group for each order.
_DATE = re.compile(rf"(?=((?:{_YEARS})(?:{_MONTH}{_DAY}|-{_MONTH}-{_DAY}|/{_MONTH}/{_DAY}|\.{_MONTH}\.{_DAY}))?"
                   rf"({_DAY}(?:{_MONTH}|-{_MONTH}-|/{_MONTH}/|\.{_MONTH}\.){_YEARS})?)", re.A)
_YEAR = re.compile(rf"(?=({_YEARS}))", re.A)
_DATE_COST = math.log10(366 * 200)
_YEAR_COST = math.log10(200)
_SEGMENT = math.log10(2)


def _alphabet(s: str) -> float:
    """log10 of the symbols that brute force tries for each character."""
    n = (10 * any("0" <= c <= "9" for c in s) + 26 * any("a" <= c <= "z" for c in s)
         + 26 * any("A" <= c <= "Z" for c in s))
    other = any(not (c.isascii() and c.isalnum()) for c in s)
    if s and not other and all(c in "0123456789abcdef" for c in s):
        n = min(n, 16)
    return math.log10(max(2, n + 33 * other))


#: Shortest word that is ranked, longest block of a repeat, and shortest walk.
MIN_WORD, MAX_BLOCK, MIN_WALK = 3, 4, 3


class Words:
    """log10 ranks of words, from the words that people choose and then the given ones, best first."""

    def __init__(self, more=()):
        self.rank: dict[str, float] = {}
        for w in [*COMMON_WORDS, *more]:
            self.rank.setdefault(w, math.log10(len(self.rank) + 2))
        self.longest = max(map(len, self.rank))


def vocabulary(rank_file: str) -> list[str]:
    """Lower-case words of a tokenizer's rank file: tokens of a blank and letters, in the order of their ranks."""
    with open(rank_file, "rb") as f:
        ranked = sorted((int(n), base64.b64decode(token)) for token, n in (line.split() for line in f if line.strip()))
    words = (token[1:].decode("utf-8", "replace") for _, token in ranked if token[:1] == b" ")
    return list(dict.fromkeys(w.lower() for w in words if len(w) >= MIN_WORD and w.isalpha()))


COMMON = Words()


def guess_cost(s: str, words: Words = COMMON) -> float:
    """log10 of the guesses of the cheapest segmentation of the whole value."""
    n, brute = len(s), _alphabet(s)
    low = "".join(c.lower() if len(c.lower()) == 1 else c for c in s)
    plain = low.translate(_LEET)
    dates: dict[int, list[tuple[int, float]]] = {}
    for pattern, cost in ((_DATE, _DATE_COST), (_YEAR, _YEAR_COST)):
        for m in pattern.finditer(s):
            for group in filter(None, m.groups()):
                dates.setdefault(m.start() + len(group), []).append((m.start(), cost))
    walk_cost = math.log10(len(_NEXT)) + math.log10(max(1, n)) + _SEGMENT
    best = [0.0] + [math.inf] * n
    walk, linked = math.inf, 1          # cheapest walk that ends here, characters that are linked up to here
    repeat = [[math.inf] * (n + 1) for _ in range(MAX_BLOCK + 1)]  # cheapest repeat that ends at a place, by block
    same = [0] * (MAX_BLOCK + 1)        # characters up to here that equal the ones a block before
    for j in range(1, n + 1):
        cost = best[j - 1] + brute
        for i in range(max(0, j - words.longest), j - MIN_WORD + 1):
            for form, extra in ((low, 0.0), (plain, 0.3)):
                if (rank := words.rank.get(form[i:j])) is not None:
                    cost = min(cost, best[i] + rank + extra + (0.3 if s[i:j] != low[i:j] else 0.0) + _SEGMENT)
                    break
        for i, c in dates.get(j, ()):
            cost = min(cost, best[i] + c + _SEGMENT)
        for size in range(1, MAX_BLOCK + 1):
            same[size] = same[size] + 1 if j > size and s[j - 1] == s[j - 1 - size] else 0
            blocks = 3 if size == 1 else 2
            if same[size] >= (blocks - 1) * size:
                new = best[j - blocks * size] + size * brute + math.log10(n // size) + _SEGMENT
                repeat[size][j] = min(new, repeat[size][j - size])  # one block more costs no more
                cost = min(cost, repeat[size][j])
        linked = linked + 1 if j > 1 and (low[j - 2], low[j - 1]) in _NEXT else 1
        walk = min(walk, best[j - MIN_WALK] + walk_cost) if linked >= MIN_WALK else math.inf
        best[j] = min(cost, walk)
    return best[n]


class Covered:
    """Stretches of text that spans cover, to test others against."""

    def __init__(self, spans):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b, _ in sorted(spans):
            if self.ends and a <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def overlap(self, start: int, end: int) -> bool:
        i = bisect.bisect_left(self.starts, end) - 1
        return i >= 0 and self.ends[i] > start


def scan(text: str, kinds: set[str], min_log10: float = MIN_LOG10, words: Words = COMMON) -> tuple[list[tuple[int, int, str]], float | None]:
    """Spans of one text, for the kinds that may occur, and the highest guess cost of a credential value."""
    spans, top = [], None
    if "assign" in kinds:
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 8:
                spans.append((m.start(), m.end(), "assign"))
    if "access" in kinds:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    if "hex" in kinds:
        spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    if "context" in kinds:
        covered = Covered(spans)
        for m in CONTEXT.finditer(text):
            start, value = m.start(1), m[1].rstrip(".:!?)]}")
            if not value:
                continue
            cost = guess_cost(value, words)
            top = cost if top is None else max(top, cost)
            end = start + len(value)
            if cost >= min_log10 and not covered.overlap(start, end):
                spans.append((start, end, "guess"))
    return sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]), x[1])), top


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


SCHEMA = ("doc_id long, n_assign long, n_access long, n_hex long, n_guess long, base_sha256 string, spans string, "
          "log10_guesses double")


def find_secrets(docs: DataFrame, min_log10: float = MIN_LOG10, rank_file: str | None = None) -> DataFrame:
    """A row for each row of ``docs``: counts, spans and the highest guess cost (null without credential values).
    ``rank_file``: a tokenizer's rank file, read by the driver, whose words are ranked too."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(rank_file) if rank_file else [])

    def run(batches):
        words = Words(shared.value)
        for b in batches:
            texts = b.column(1).fill_null("")
            may = {k: pc.match_substring_regex(texts, p).to_numpy(zero_copy_only=False) for k, p in MAY.items()}
            out: list[list] = [[] for _ in range(7)]
            empty = (0, 0, 0, 0, hashlib.sha256(b"").hexdigest(), "", None)
            for i in range(len(texts)):
                row, kinds = empty, {k for k, hit in may.items() if hit[i]}
                if kinds:
                    spans, top = scan(texts[i].as_py(), kinds, min_log10, words)
                    base = joined(x for x in spans if x[2] != "guess")
                    row = (*(sum(x[2] == k for x in spans) for k in KINDS),
                           hashlib.sha256(base.encode()).hexdigest(), joined(spans), top)
                for column, v in zip(out, row, strict=True):
                    column.append(v)
            kinds_of = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, t) for c, t in zip(out, kinds_of, strict=True))],
                ["doc_id", "n_assign", "n_access", "n_hex", "n_guess", "base_sha256", "spans", "log10_guesses"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(run, SCHEMA)
