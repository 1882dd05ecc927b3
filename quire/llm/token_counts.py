"""Token counts: every distinct pre-token is counted once, and documents sum the counts of theirs.

The model's pieces never hold a space mark after another character, nor a line end, so no merge crosses
the place before a run of spaces or around a line end: the tokens of a text are those of its pre-tokens
(a run of spaces with what follows up to the next space or line end). Line ends count for themselves.

A pre-token goes by its name: itself, or a digest of it if it is long, so that text without spaces moves once
at most.

1. One pass over the texts counts pre-tokens per task, a shuffle adds the tasks' counts up, and each
   distinct pre-token is encoded once (table ``counts``).
2. The most frequent pre-tokens with their counts are broadcast, HEAD at most, whatever the data.
3. A second pass sums head counts per document where it stands, and sends only the frequencies of other
   pre-tokens through a join with ``counts``; one aggregation by row adds both.

No token id is ever kept. Hot pre-tokens are in the head, so the join sees only rare keys.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quire.llm._shared import small_batches, table, write_table

MODEL = "piece_bpe_32k.model"
#: Pre-tokens whose counts are broadcast, and distinct pre-tokens that a task holds before it passes them on.
HEAD, HELD = 300_000, 400_000
#: Longest pre-token, in characters, that is its own name, and characters of longer ones that a task holds.
LONGEST, HELD_CHARACTERS = 64, 16_000_000
LIMIT = 4096
SPACE_MARK = "▁"
PRE_TOKEN = re.compile(r" *[^ \n]+| +")


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pre_tokens(text: str) -> tuple[list[str], int]:
    """The pre-tokens of a text, with the leading space that the model adds, and the number of line ends."""
    if not text:
        return [], 0
    text = " " + text.replace(SPACE_MARK, " ")
    return PRE_TOKEN.findall(text), text.count("\n")


def name_of(pre: str) -> str:
    """What a pre-token is known by; a line end, which no pre-token has, leads the digests."""
    return pre if len(pre) <= LONGEST else "\n" + xxhash.xxh3_128_hexdigest(pre.encode())


class PieceCounter:
    """Counts the pieces of pre-tokens; opened once per process."""

    _open: dict = {}

    def __init__(self, path: str):
        if path not in self._open:
            self._open[path] = sentencepiece.SentencePieceProcessor(model_file=path)
        self.model = self._open[path]
        #: What the line end before a pre-token adds: it keeps the model from adding a space to the pre-token itself.
        self.guard = len(self.model.encode("\n"))

    def __call__(self, pre: list[str]) -> list[int]:
        return [len(ids) - self.guard for ids in self.model.encode(["\n" + p for p in pre], num_threads=1)]


def distinct_counts(docs: DataFrame, path: str) -> DataFrame:
    """(name, freq, n): every distinct pre-token by its name, its frequency over all texts, and its pieces."""

    def tally(batches):
        held: Counter = Counter()
        size = 0
        for b in batches:
            for t in b.column(0):
                found = pre_tokens(t.as_py() or "")[0]
                held.update(found)
                size += sum(n for n in map(len, found) if n > LONGEST)
                if len(held) > HELD or size > HELD_CHARACTERS:
                    yield _tallied(held)
                    held.clear()
                    size = 0
        yield _tallied(held)

    def encoded(batches):
        count = PieceCounter(path)
        for b in batches:
            whole = [name if pre is None else pre for name, pre in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            yield pa.record_batch([b.column(0), b.column(2), pa.array(count(whole), pa.int32())], ["name", "freq", "n"])

    tallied = docs.select("text").mapInArrow(tally, "name string, pre string, freq long")
    return tallied.groupBy("name", "pre").agg(F.sum("freq").alias("freq")).mapInArrow(encoded, "name string, freq long, n int")


def _tallied(held: Counter) -> pa.RecordBatch:
    """Counts by name, with the pre-token itself where its name is a digest."""
    whole = [pre if len(pre) > LONGEST else None for pre in held]
    return pa.record_batch([pa.array(list(map(name_of, held)), pa.string()), pa.array(whole, pa.string()), pa.array(list(held.values()), pa.int64())], ["name", "pre", "freq"])


def frequent(counts: DataFrame, most: int) -> DataFrame:
    """The most frequent rows of counts, most at most: all above a frequency that a histogram on a logarithmic scale gives.

    The histogram has some hundred rows at any size of the data, so nothing is sorted and no task sees all rows.
    """
    step = F.floor(F.log2("freq") * 16).alias("step")
    cut, total = None, 0
    for r in sorted(counts.groupBy(step).agg(F.count("*").alias("rows")).collect(), key=lambda r: -r["step"]):
        total += r["rows"]
        if total > most:
            break
        cut = r["step"]
    return counts.where(F.lit(False) if cut is None else step >= cut)


def token_counts(docs: DataFrame, path: str | None = None, limit: int = LIMIT, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Tokens of every whole text as the model's library gives them, without begin and end tokens.

    Returns (doc_id, n_bytes, n_tokens, over_limit), one row per row of docs, repeated rows and null ids
    included. Null and empty texts have no bytes and no tokens. Texts of any length, with or without spaces,
    go the same way; a task holds one whole text. Other columns are left out, so their names cannot clash.
    An empty table gives an empty one.
    """
    spark = docs.sparkSession
    small_batches(spark)
    path = path or model_path()
    docs = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    counts = write_table(distinct_counts(docs, path), "pre-token-counts")
    head = frequent(counts, HEAD).select("name", "n").toArrow()
    known = spark.sparkContext.broadcast(dict(zip(head["name"].to_pylist(), head["n"].to_pylist())))

    def spread(batches):
        """A row per document with what the head gives, and a row per rarer pre-token of it.

        A document's own row carries line ends and its number as name: no pre-token is like it, and the rows spread evenly.
        """
        have = known.value
        for b in batches:
            out: tuple[list, ...] = ([], [], [], [], [])

            def emit(*values, out=out):
                for column, v in zip(out, values):
                    column.append(v)

            for row, doc_id, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                text = t.as_py() or ""
                found, total = pre_tokens(text)
                for pre, times in Counter(found).items():
                    n = have.get(pre)
                    if n is None and len(pre) > LONGEST:
                        pre = name_of(pre)
                        n = have.get(pre)
                    if n is not None:
                        total += n * times
                    else:
                        emit(row, None, pre, times, None)
                emit(row, doc_id, f"\n\n{row}", total, len(text.encode()))
            for i in range(0, len(out[0]), 20_000):
                yield pa.record_batch([pa.array(c[i : i + 20_000], k) for c, k in zip(out, (pa.int64(), id_kind, pa.string(), pa.int64(), pa.int64()))], ["row", "doc_id", "name", "number", "n_bytes"])

    id_type = docs.schema["doc_id"].dataType
    id_kind = to_arrow_type(id_type)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    spreads = rows.mapInArrow(spread, f"row long, doc_id {id_type.simpleString()}, name string, number long, n_bytes long")
    met = spreads.join(counts.select("name", "n"), "name", "left")
    total = F.sum(F.col("number") * F.coalesce("n", F.lit(1)))
    summed = met.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), total.alias("n_tokens"))
    return summed.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document, as token_counts states it."""
    return token_counts(table(spark, sf_dir, "documents"))
