"""Line-first cleaning: rules judge single lines, failing lines go, and a document goes when
it loses too much of its text.

Rules per line (only lines that hold a word are judged):

``punctuation``  ASCII punctuation makes up more than ``MAX_PUNCT_PERCENT`` of the line's word
                 characters;
``navigation``   at least ``MIN_SEPARATORS`` stand-alone separators (``|``, ``>``, ``»``, ``•``,
                 ``/``) that make up ``SEPARATOR_PERCENT`` of the line's words, or a line of at most
                 ``NAV_MAX_WORDS`` words of which more than half belong to :data:`NAV_WORDS`;
``boilerplate``  one of :data:`BOILERPLATE` occurs in the lower-cased line.

A document is rejected when it fails the base check (fewer than 50 words, or more than half of
its words in repeated three-word windows) or when the kept lines hold less than
``MIN_KEPT_PERCENT`` of its word characters. Everything is decided per document, in one pass over the scan: no shuffle, no
state beyond one document.

Cases: a null or empty text has no lines, fails the base check (fewer than 50 words) and its
cleaned text is the text itself (null stays null); repeated rows and ties are judged row by row;
a very long text takes memory in proportion to itself only; extra columns pass through
untouched, and result columns that clash with input columns (in any letter case) replace them; an empty table
gives none.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinscore.llm.common import Shelter, require, slices, with_text

#: words of page furniture, lower case
NAV_WORDS = frozenset(
    b"home about contact login logout menu search next previous prev back top share print faq help "
    b"sitemap register subscribe signup sign cart account".split()
)
#: phrases of page furniture and notices, lower case
BOILERPLATE = (
    "all rights reserved",
    "terms of use",
    "terms of service",
    "privacy policy",
    "cookie policy",
    "uses cookies",
    "enable javascript",
    "click here to",
    "subscribe to our newsletter",
    "lorem ipsum",
)
SYMBOLS = "#*$%&|<>"
SEPARATORS = frozenset((b"|", b">", b"/", "»".encode(), "•".encode()))
PUNCT = bytes(c for c in range(33, 127) if not chr(c).isalnum())
BLANKS = " \t\n\x0b\x0c\r"

MAX_PUNCT_PERCENT = 15
MIN_SEPARATORS = 3
SEPARATOR_PERCENT = 20
NAV_MAX_WORDS = 8
MIN_KEPT_PERCENT = 50

_BOILER = re.compile("|".join(BOILERPLATE).encode())
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("word_chars", T.LongType()),
    T.StructField("n_symbols", T.LongType()),
    T.StructField("n_dup_lines", T.LongType()),
    T.StructField("n_repeat_words", T.LongType()),
    T.StructField("base_failed", T.BooleanType()),
    T.StructField("n_removed_lines", T.LongType()),
    T.StructField("kept_chars", T.LongType()),
    T.StructField("kept", T.BooleanType()),
    T.StructField("clean_text", T.StringType()),
]


def repeat_words(words: list[bytes]) -> int:
    """Words covered by a three-word window that occurs twice or more, its first place included."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    first: dict[tuple, int] = {}
    hit = bytearray(len(words))
    for i, w in enumerate(windows):
        j = first.setdefault(w, i)
        if j != i:
            hit[j : j + 3] = b"\1\1\1"
            hit[i : i + 3] = b"\1\1\1"
    return hit.count(1)


def line_fails(line: bytes, chars: int, words: list[bytes]) -> bool:
    """``chars``: code points of the line's words."""
    n_punct = len(line) - len(line.translate(None, PUNCT))
    if 100 * n_punct > MAX_PUNCT_PERCENT * chars:
        return True
    n = len(words)
    seps = sum(w in SEPARATORS for w in words)
    if seps >= MIN_SEPARATORS and 100 * seps >= SEPARATOR_PERCENT * n:
        return True
    low = line.translate(_LOWER)
    if n <= NAV_MAX_WORDS and 2 * sum(w in NAV_WORDS for w in low.split()) > n:
        return True
    return _BOILER.search(low) is not None


def judge(text: str | None) -> tuple:
    """The values of ``_FIELDS`` for one text."""
    raw = (text or "").encode()
    words = raw.split()
    blanks = sum(map((text or "").count, BLANKS))
    word_chars = len(text or "") - blanks
    n_symbols = sum(map((text or "").count, SYMBOLS))
    seen: set[bytes] = set()
    kept: list[bytes] = []
    n_dup = n_removed = kept_chars = 0
    for line in raw.split(b"\n"):
        own = line.split()
        if not own:
            kept.append(line)
            continue
        if line in seen:
            n_dup += 1
        else:
            seen.add(line)
        joined = b"".join(own)
        chars = len(joined) if joined.isascii() else len(joined.decode())
        if line_fails(line, chars, own):
            n_removed += 1
        else:
            kept.append(line)
            kept_chars += chars
    n_repeat = repeat_words(words)
    failed = len(words) < 50 or 100 * n_repeat > 50 * len(words)
    keep = not failed and 100 * kept_chars >= MIN_KEPT_PERCENT * word_chars
    clean = text if n_removed == 0 else b"\n".join(kept).decode()
    return len(words), word_chars, n_symbols, n_dup, n_repeat, failed, n_removed, kept_chars, keep, clean


def quality_rules(docs: DataFrame, text: str = "text", keep_clean: bool = True, prefix: str = "") -> DataFrame:
    """All columns of ``docs`` plus the fields above (``clean_text`` only with ``keep_clean``),
    their names led by ``prefix``."""
    require(docs, text)
    fields = [T.StructField(prefix + f.name, f.dataType) for f in (_FIELDS if keep_clean else _FIELDS[:-1])]
    shelter = Shelter(docs, [f.name for f in fields], text)
    own_text, passed = shelter.names[text], [f.name for f in shelter.fields]
    schema = T.StructType(shelter.fields + fields)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(schema)
        for batch in slices(batches, own_text):
            found = list(zip(*map(judge, batch.column(own_text).to_pylist()), strict=True))
            own = [pa.array(v, out.field(f.name).type) for f, v in zip(fields, found, strict=False)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).cast(out.field(c).type) for c in passed] + own, schema=out
            )

    judged = shelter.source.mapInArrow(run, schema)
    return judged.select(*shelter.restored(), *(f.name for f in fields))


def accepted(docs: DataFrame, text: str = "text") -> DataFrame:
    """The kept documents with their failing lines removed, in the columns of ``docs``;
    ``n_chars``, where there is one, follows the new text."""
    judged = quality_rules(docs, text, prefix="__rule_").where("__rule_kept")
    return with_text(judged, docs, F.col("__rule_clean_text"), text)
