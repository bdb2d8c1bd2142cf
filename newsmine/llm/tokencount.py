"""Token counts from pre-token frequencies: each distinct pre-token is encoded once, no ids are kept."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from newsmine.llm.common import narrow, original, per_batch, sampled, stored

#: The byte-level pre-token pattern (fixed value of the format).
PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Code points on which the two Unicode tables (the pattern's and the library's) agree; other texts go to the library.
_AGREED = regex.compile("[\u0000-՗ -₎₠-⯿　-꓏가-힣\U0001f000-\U0001faff]*")
DICTIONARY = 200_000  # entries of the table of frequent pre-tokens that every task gets
LONGEST = 64  # characters of such an entry


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


class Splitter:
    """Cuts texts into pre-tokens; special strings count one token each and cut before and after."""

    def __init__(self, path: str) -> None:
        self.tokenizer = _tokenizer(path)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        longest_first = sorted(special, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, longest_first))) if special else None

    def _plain(self, text: str) -> list[str]:
        if text.isascii() or _AGREED.fullmatch(text):
            return PATTERN.findall(text)
        return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def __call__(self, text: str) -> tuple[list[str], int]:
        if self.special is None or not self.special.search(text):
            return self._plain(text), 0
        parts = self.special.split(text)
        return [p for part in parts for p in self._plain(part)], len(parts) - 1

    def sizes(self, pieces: list[str]) -> list[int]:
        """Tokens of each pre-token; a pre-token alone is cut no further."""
        return [len(self.tokenizer.encode(p, add_special_tokens=False)) for p in pieces]


def frequent(docs: DataFrame, path: str, rows: int = 20_000) -> dict[str, int]:
    """Token counts of the most frequent pre-tokens of about ``rows`` rows.

    Only a help for speed: it decides where a pre-token is looked up, not its
    count. At most DICTIONARY entries of at most LONGEST characters.
    """
    chosen = sampled(docs.select("doc_id", "text"), rows, F.col("doc_id"))

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, seen = Splitter(path), Counter()
        for batch in batches:
            for text in batch.column(0):
                seen.update(split(text.as_py() or "")[0])
                if len(seen) > 1_000_000:
                    yield _counted(seen)
                    seen = Counter()
        yield _counted(seen)

    found = narrow(chosen).select("text").mapInArrow(counts, "piece string, n long")
    top = found.groupBy("piece").agg(F.sum("n").alias("n")).where(F.length("piece") <= LONGEST).orderBy(F.desc("n"), "piece").limit(DICTIONARY)
    return {r["piece"]: r["tokens"] for r in _sized(top.select("piece"), path).collect()}


def _counted(seen: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["piece", "n"])


def _sized(pieces: DataFrame, path: str) -> DataFrame:
    """(piece, tokens) of each distinct pre-token."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sizes = Splitter(path).sizes(batch.column(0).to_pylist())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], names=["piece", "tokens"])

    return pieces.mapInArrow(per_batch(work), "piece string, tokens long")


def token_counts(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row of ``docs``.

    Texts are cut once. Frequencies of pre-tokens in the bounded table of
    ``frequent`` are joined to it inside the task; all others go to a table of
    (row, pre-token, frequency), whose distinct pre-tokens are encoded once each
    and joined back. As what is frequent stays in the task, no join key is hot.

    A null or empty text has 0 bytes and tokens. Repeated rows are counted one by
    one, null doc_ids stay null, other columns are not read. An empty table gives
    an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent(docs, path))

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        split, known = Splitter(path), shared.value
        at = 0
        while at < batch.num_rows:  # few rows at a time: texts may be long
            rows = batch.slice(at, 256)
            at += rows.num_rows
            sums, names, counts = [], [], []
            for text in rows.column(1):
                pieces, total = split(text.as_py() or "")
                rest: dict[str, int] = {}
                for piece, n in Counter(pieces).items():
                    size = known.get(piece)
                    if size is None:
                        rest[piece] = n
                    else:
                        total += n * size
                sums.append(total)
                names.append(list(rest))
                counts.append(list(rest.values()))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(2), pa.array(sums, pa.int64()), pa.array(names, pa.list_(pa.string())), pa.array(counts, pa.list_(pa.int64()))],
                names=["id", "n_bytes", "known", "pieces", "times"],
            )

    sized = narrow(docs).withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))
    cut = sized.mapInArrow(per_batch(work), "id long, n_bytes long, known long, pieces array<string>, times array<long>")
    rows = stored(cut.withColumn("row", F.monotonically_increasing_id()), "token-rows")
    rest = rows.select("row", F.explode(F.arrays_zip("pieces", "times")).alias("x")).select("row", F.col("x.pieces").alias("piece"), F.col("x.times").alias("n"))
    encoded = _sized(rest.select("piece").distinct(), path)
    more = rest.join(encoded, "piece").groupBy("row").agg(F.sum(F.col("n") * F.col("tokens")).alias("more"))
    total = F.col("known") + F.coalesce("more", F.lit(0))
    return rows.select("row", "id", "n_bytes", "known").join(more, "row", "left").select(
        original(F.col("id")).alias("doc_id"), "n_bytes", total.alias("n_tokens"), (total > limit).alias("over_limit")
    )
