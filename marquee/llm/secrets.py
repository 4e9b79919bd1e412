"""Secret scan: patterns, and the cost of guessing the values that stand in a credential context.

A value's cost is the least total, over all ways to cut it into spans, of the spans' guesses as
powers of ten: dictionary words by rank (with capitals, or letters written as digits), dates, repeats of a
shorter part, runs along the alphabet or a keyboard row, and brute force over the alphabets that a
span's characters come from; characters outside ASCII cost as marks do.  The cut is found by dynamic programming over the
whole value, however long.  Values that cost more than ``COSTLY`` are spans of kind ``guess``, beside the spans of the base patterns.

A quoted value goes to its closing quote on the line, blanks and other quotes included; any other value to the next
blank or quote.  Links and paths are lists of names that anyone may read: they cost what the most costly of their parts does.

Offsets count code points, the end is exclusive.  A null text is empty and has no spans; repeated
rows give equal results; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from math import log10

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import id_and_text

# Kinds of spans in the order in which equal starts are listed.
KINDS = ("assign", "access", "hex", "guess")
ASSIGN = r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
ASSIGN_CHARS, ACCESS_CHARS = 6, 20
# Contexts whose values are costed: a credential's name, a separator, the value with its quotes if it has any.
CONTEXT = (r"""(?ai)(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|access[_-]?key|"""
           r"""private[_-]?key|credential|auth)s?["']?\x20*+(?::=|=>|[:=])\x20*+"""
           r"""(?:"([^"\n\r]{6,})"|'([^'\n\r]{6,})'|`([^`\n\r]{6,})`|["'`]?([^\x00-\x20"'`\x7f]{6,}))""")
# Links, and paths of two names or more; and what stands between their parts.
LINK = re.compile(r"(?ai)(?:[a-z][a-z0-9+.-]*:)?//[^/]|(?:[~.]{0,2}|[a-z]:)(?:[/\\][\w.~-]+){2,}[/\\]?$")
LINK_PARTS = re.compile(r"[/\\:?&=#@.,;%+~_-]+")
# Least cost of a value that counts as a secret, as a power of ten.
COSTLY = 10.0
# Added for every cut: the guesser does not know where spans meet.
CUT = 0.5
# Sizes of the alphabets that brute force goes through; characters that are no ASCII letter or digit are marks.
DIGITS, LOWER, UPPER, MARKS = 1, 2, 4, 8
ALPHABETS = {DIGITS: 10, LOWER: 26, UPPER: 26, MARKS: 33}
# Longest span that is looked up as a word, date or repeat; longer ones are several spans.
LONGEST_WORD, LONGEST_DATE, LONGEST_PART = 24, 10, 24

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Passwords that are guessed first, in order, and keyboard rows.
COMMON = ("123456 password 12345678 qwerty 123456789 12345 1234 111111 1234567 dragon 123123 baseball abc123 football "
          "monkey letmein shadow master 666666 qwertyuiop 123321 mustang 1234567890 michael 654321 superman 1qaz2wsx "
          "7777777 121212 000000 qazwsx 123qwe killer trustno1 jordan jennifer zxcvbnm asdfgh hunter buster soccer "
          "harley batman andrew tigger sunshine iloveyou charlie robert thomas hockey ranger daniel starwars "
          "112233 george computer michelle jessica pepper 1111 zxcvbn 555555 11111111 131313 freedom 777777 pass "
          "maggie 159753 aaaaaa ginger princess joshua cheese amanda summer love ashley 6969 nicole chelsea "
          "matthew access yankees 987654321 dallas austin thunder taylor matrix admin changeme welcome secret "
          "default example test guest root user token").split()
ROWS = ("abcdefghijklmnopqrstuvwxyz", "0123456789", "1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "qwertzuiop",
        "azertyuiop", "1qaz2wsx3edc4rfv5tgb6yhn7ujm8ik9ol0p", "!@#$%^&*()")
LEET = str.maketrans("4@831!05$7+", "aabeiiosstt")
DATE = re.compile(r"(?:(?:19|20)\d\d([-/._]?)(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12]\d|3[01])"
                  r"|(?:0?[1-9]|[12]\d|3[01])([-/._]?)(?:0?[1-9]|1[0-2])\2(?:19|20)?\d\d|(?:19|20)\d\d)$")


def read_words(path: str = VOCABULARY, least: int = 3) -> dict[str, float]:
    """Words of a ranked vocabulary file with the power of ten of their rank; the file is read on the driver."""
    costs: dict[str, float] = {w: log10(i + 2) for i, w in enumerate(COMMON)}
    with open(path, "rb") as lines:
        for rank, line in enumerate(lines):
            token = base64.b64decode(line.split()[0])
            if token.startswith(b" ") and len(token) > least and token[1:].isalpha() and token.isascii():
                costs.setdefault(token[1:].decode().lower(), log10(rank + 2))
    return costs


def alphabet(char: str) -> int:
    """The alphabet of a character."""
    return DIGITS if "0" <= char <= "9" else LOWER if "a" <= char <= "z" else UPPER if "A" <= char <= "Z" else MARKS


# By union of alphabets: the power of ten of the guesses for each character.
BRUTE = [0.0] + [log10(sum(size for kind, size in ALPHABETS.items() if kind & union)) for union in range(1, 16)]
# By alphabet: the unions that hold it.
UNIONS = {kind: [union for union in range(1, 16) if union & kind] for kind in ALPHABETS}


def _steps() -> dict[tuple[str, str], list[int]]:
    """Neighbours on a row, with the rows and directions (a sign) in which they are."""
    out: dict[tuple[str, str], list[int]] = {}
    for i, row in enumerate(ROWS, 1):
        for a, b in zip(row, row[1:]):
            out.setdefault((a, b), []).append(i)
            out.setdefault((b, a), []).append(-i)
    return out


def coster(words: dict[str, float]) -> Callable[[str], float]:
    """Function from a value to the power of ten of the guesses it takes."""

    def word(part: str, low: str) -> float | None:
        if part == low:
            extra = 0.0
        else:
            extra = 0.3 if part in (part.upper(), part.capitalize()) else 1.0
        if low in words:
            return words[low] + extra
        plain = low.translate(LEET)
        return words[plain] + extra + 0.6 if plain in words else None

    def guessed(kinds: list[int]) -> float:
        """One span of brute force."""
        union = 0
        for kind in kinds:
            union |= kind
        return len(kinds) * BRUTE[union]

    steps = _steps()

    @lru_cache(maxsize=4096)
    def cost(value: str) -> float:
        n = len(value)
        low = value.lower()
        best = [0.0] + [float("inf")] * n
        kinds = [alphabet(c) for c in value]
        # By union of alphabets: the least cost up to here whose last span is brute force over that union.
        brute = [float("inf")] * len(BRUTE)
        walks: dict[int, int] = {}
        # By width: how many characters up to here equal the one that many places before.
        same = [0] * (LONGEST_PART + 1)
        for end in range(1, n + 1):
            # Brute force costs as much for each character as its span's alphabets together; a run of it is one span.
            fresh, runs = best[end - 1] + (CUT if end > 1 else 0.0), brute
            brute = [float("inf")] * len(BRUTE)
            for union in UNIONS[kinds[end - 1]]:
                brute[union] = min(runs[union], fresh) + BRUTE[union]
            least = min(brute)
            for start in range(max(0, end - LONGEST_WORD), end - 2):
                found = word(value[start:end], low[start:end])
                if found is not None:
                    least = min(least, best[start] + found + (CUT if start else 0.0))
            if value[end - 1].isdigit():
                for start in range(max(0, end - LONGEST_DATE), end - 3):
                    if value[start].isdigit() and DATE.match(value, start, end):
                        date = log10(365 * 120 if end - start > 4 else 120)
                        least = min(least, best[start] + date + (CUT if start else 0.0))
            # Runs along a row: how far each goes back from here, shorter ones being part of it.
            walks = {row: walks.get(row, 1) + 1 for row in steps.get((low[end - 2:end - 1], low[end - 1]), ())}
            for length in range(3, max(walks.values(), default=0) + 1):
                walk = log10(4 * len(ROWS) * 10 * length)
                least = min(least, best[end - length] + walk + (CUT if end > length else 0.0))
            # Repeats: the part is paid once, then the number of times.
            for width in range(1, min(LONGEST_PART, end - 1) + 1):
                same[width] = same[width] + 1 if value[end - 1] == value[end - 1 - width:end - width] else 0
                times = same[width] // width + 1
                if times * width > 2 and times > 1:
                    part = value[end - width:end]
                    once = guessed(kinds[end - width:end])
                    if width > 1 and (known := word(part, part.lower())) is not None:
                        once = min(once, known)
                    for many in {2, times} if width > 1 else {times}:
                        start = end - many * width
                        least = min(least, best[start] + once + log10(many) + (CUT if start else 0.0))
            best[end] = least
        return best[n]

    return cost


def spans_of(text: str, cost: Callable[[str], float]) -> list[tuple[str, int, int, float | None]]:
    """All spans of a text as ``(kind, start, end, cost)``, by start, then kind as listed."""
    out = []
    if ":" in text or "=" in text:
        for m in re.finditer(ASSIGN, text):
            if m.end(2) - m.start(2) >= ASSIGN_CHARS:
                out.append(("assign", m.start(), m.end(), None))
        for m in re.finditer(CONTEXT, text):
            value, at = m[m.lastindex], m.span(m.lastindex)
            guesses = max(map(cost, LINK_PARTS.split(value))) if LINK.match(value) else cost(value)
            if guesses > COSTLY:
                out.append(("guess", *at, guesses))
    if "AKIA" in text:
        for m in re.finditer(ACCESS, text):
            if m.end() - m.start() >= ACCESS_CHARS:
                out.append(("access", m.start(), m.end(), None))
    out += [("hex", m.start(), m.end(), None) for m in re.finditer(HEX, text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


SCHEMA = "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint,log10_guesses:double>>"
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("log10_guesses", pa.float64())]))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id`` and ``spans`` of every document."""
    words = read_words(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost = coster(words)
        names = [f.name for f in _SPANS.value_type]
        for batch in batches:
            found = [[dict(zip(names, s)) for s in spans_of(t, cost)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _SPANS)], names=["doc_id", "spans"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def listed(spans, kinds=KINDS):
    """Spans of some kinds as ``kind:start:end``, comma-joined."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def summary(found: DataFrame) -> DataFrame:
    """Counts by base kind, the digest of the base spans, and all spans as text."""
    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, KINDS),
        F.sha2(listed(F.col("spans"), KINDS[:3]).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
