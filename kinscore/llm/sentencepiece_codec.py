"""SentencePiece encoding and decoding with a distinct-chunk table.

In a BPE model whose pieces never hold a marker (U+2581) behind another character, no merge can
cross from a word into the marker of the next one, so the marked words of a text are
segmented independently. A text is cut in front of every run of blanks; each distinct marked
word is segmented once, by the library, into a table, and the ids of all words are
joined back by their positions in the text.

The table lives in the task that fills it and is renewed when it holds ``TABLE_WORDS`` words: a
corpus-wide table would have to shuffle every word of the corpus twice to save a segmentation
that costs less than the shuffle. Documents need no exchange at all; the plan is
scan, map, write.

The condition is checked against the model's pieces when a task starts; a model that breaks it
(or rewrites text in its normaliser) is run over whole texts, with the same results.

Cases: a null or empty text is the end id alone and decodes to the empty string; literal markers
count as blanks, as in the library; repeated rows are encoded row by row; a very long text takes
memory in proportion to itself; extra columns pass through, result columns replace
those that clash (in any letter case); an empty table gives none.
"""

from __future__ import annotations

import hashlib
import re
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinscore.llm.common import Shelter, named, passed_columns, require, slices, with_text

MARK = "▁"
#: words a task's table holds before it starts anew
TABLE_WORDS = 500_000
#: distinct words handed to the library at once
LOOKUP_WORDS = 20_000


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class ChunkTable:
    """ids of marked words, each segmented once."""

    def __init__(self, model: str, words: int = TABLE_WORDS):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.eos = self.sp.eos_id()
        self.words = words
        self.ids: dict[str, list[int]] = {}
        pieces = (self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size()))
        crossing = any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces)
        probe = "Å  x　y\xa0ﬁ Å​\tz\n"
        plain = self.sp.normalize(probe) == MARK + probe.replace(" ", MARK)
        self.independent = not crossing and plain
        # a single blank at the end of a text: the library would not mark an empty word
        self.blank = self.sp.encode("a ")[len(self.sp.encode("a")) :]

    def _add(self, words: set[str]) -> None:
        new = words - self.ids.keys()
        if len(self.ids) + len(new) > self.words:  # start anew with what this slice needs
            self.ids.clear()
            new = words
        new = list(new)
        # the library puts one marker in front of what it encodes: the first blank of the word
        for i in range(0, len(new), LOOKUP_WORDS):
            part = new[i : i + LOOKUP_WORDS]
            self.ids.update(zip(part, self.sp.encode([w[1:] for w in part], num_threads=1), strict=True))
        if " " in words:
            self.ids[" "] = self.blank

    def encode(self, texts: list[str]) -> list[list[int]]:
        """The ids of every text, the end id last."""
        if not self.independent:
            return [ids + [self.eos] for ids in self.sp.encode(texts, num_threads=1)]
        parts = [_marked_words(t) for t in texts]
        self._add(set(chain.from_iterable(parts)))
        table = self.ids
        out = []
        for words in parts:
            ids = list(chain.from_iterable(map(table.__getitem__, words)))
            ids.append(self.eos)
            out.append(ids)
        return out


def _marked_words(text: str) -> list[str]:
    """The text with a leading blank, cut in front of each run of blanks."""
    if not text:
        return []
    if MARK in text:
        text = text.replace(MARK, " ")
    if "  " not in text and text[0] != " " and text[-1] != " ":
        return [" " + w for w in text.split(" ")]
    return re.findall(" +[^ ]*", " " + text)


_FIELDS = [
    T.StructField("n_tokens", T.LongType()),
    T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
    T.StructField("ids_sha256", T.StringType()),
    T.StructField("decoded", T.StringType()),
    T.StructField("decoded_sha256", T.StringType()),
]


def sentencepiece_codec(
    docs: DataFrame, text: str = "text", model: str | None = None, fields=None, prefix: str = ""
) -> DataFrame:
    """All columns of ``docs`` plus the ``fields`` (default: all) of n_tokens, ids, ids_sha256
    (of the decimal ids joined by one space), decoded and decoded_sha256 (UTF-8)."""
    require(docs, text)
    path = model or default_model()
    chosen = [f for f in _FIELDS if fields is None or f.name in fields]
    own = [T.StructField(prefix + f.name, f.dataType) for f in chosen]
    shelter = Shelter(docs, [f.name for f in own], text)
    own_text, passed = shelter.names[text], [f.name for f in shelter.fields]
    schema = T.StructType(shelter.fields + own)
    want = {f.name for f in chosen}

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(schema)
        table = ChunkTable(path)
        decimal = list(map(str, range(table.sp.get_piece_size())))
        for batch in slices(batches, own_text, limit=1 << 20):
            coded = table.encode([t or "" for t in batch.column(own_text).to_pylist()])
            plain = table.sp.decode(coded) if want & {"decoded", "decoded_sha256"} else []
            found = {}
            if "n_tokens" in want:
                found["n_tokens"] = list(map(len, coded))
            if "ids" in want:
                found["ids"] = coded
            if "ids_sha256" in want:
                found["ids_sha256"] = [
                    hashlib.sha256(" ".join(map(decimal.__getitem__, ids)).encode()).hexdigest() for ids in coded
                ]
            if "decoded" in want:
                found["decoded"] = plain
            if "decoded_sha256" in want:
                found["decoded_sha256"] = [hashlib.sha256(t.encode()).hexdigest() for t in plain]
            cols = [pa.array(found[f.name], out.field(o.name).type) for f, o in zip(chosen, own, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).cast(out.field(c).type) for c in passed] + cols, schema=out
            )

    found = shelter.source.mapInArrow(run, schema)
    return found.select(*shelter.restored(), *(f.name for f in own))


def encoded(docs: DataFrame, text: str = "text", model: str | None = None) -> DataFrame:
    """The columns of ``docs`` with the decoded text, plus ``ids`` and ``n_tokens``."""
    kept = docs.select(*map(named, passed_columns(docs, ["ids", "n_tokens"])))
    found = sentencepiece_codec(kept, text, model, fields=("n_tokens", "ids", "decoded"), prefix="__sp_")
    n, ids = F.col("__sp_n_tokens").alias("n_tokens"), F.col("__sp_ids").alias("ids")
    return with_text(found, kept, F.col("__sp_decoded"), text, n, ids)
