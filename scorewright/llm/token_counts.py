"""Token counts by a two-tier lookup, map-side: no pre-token is shuffled.

Tier one is a hash table of frequent pieces and their numbers of tokens, taken from a bounded sample of
texts and broadcast in a compact form (at most `table_size` pieces of at most 64 characters). Tier two is
each worker's own memo, which asks the tokenizer's library for what it has not met yet. The tables decide
how often the library is asked, never a count.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Remembered, chunks_of, pieces_of, worker_cache
from .tokens import CLASSES, Encoder


def frequent_pieces(texts: list[str], path: str, table_size: int) -> tuple[bytes, bytes]:
    """The most frequent pieces, and their token counts as 16-bit numbers; both compressed."""
    often = Counter()
    for k in range(0, len(texts), 200):
        codes, _, values = pieces_of(pa.array(texts[k : k + 200], pa.string()), CLASSES)
        times = np.bincount(codes, minlength=len(values)).tolist()
        often.update({p: n for p, n in zip(values.to_pylist(), times, strict=True) if len(p) <= 64})
    own = Encoder(path)
    chosen = [p for p, n in sorted(often.items(), key=lambda x: (-x[1], x[0]))[:table_size] if n > 1 and own.by_piece]
    sizes = np.array([len(own.ids(p.decode())) for p in chosen], np.uint16)
    return zlib.compress(b"\n".join(chosen)), zlib.compress(sizes.tobytes())  # no piece has a line end


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    limit: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int = 2000,
    sample_chars: int = 4000,
    table_size: int = 65_536,
) -> DataFrame:
    """One row per input row: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    `docs` needs an id and a text; other columns are ignored, whatever their names. Null texts count as
    empty: 0 bytes, 0 tokens. Null and repeated ids keep their rows. An empty table gives no rows. The
    frequent table is fitted on about `sample_rows` texts (twice as many at most), drawn from the whole table by
    a hash of id and text, and their first `sample_chars` characters; whole texts are counted.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    share = F.lit(int(min(1.0, sample_rows / max(texts.count(), 1)) * (1 << 30)))
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    drawn = texts.select(draw.alias("draw"), F.substring("text", 1, sample_chars).alias("text")).filter(F.col("draw") <= share)
    sample = drawn.orderBy("draw").limit(2 * sample_rows).select("text").collect()
    first = texts.sparkSession.sparkContext.broadcast(
        frequent_pieces([r["text"] for r in sample], tokenizer_path, table_size)
    )

    def both_tiers():
        names, sizes = first.value
        own = Encoder(tokenizer_path)
        memo = Remembered(lambda piece: len(own.ids(piece.decode())))
        sizes = np.frombuffer(zlib.decompress(sizes), np.uint16).tolist()
        if sizes:
            memo.update(zip(zlib.decompress(names).split(b"\n"), sizes, strict=True))
        return own, memo

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, memo = worker_cache("token counts", tokenizer_path, both_tiers)
        for batch in chunks_of(batches, "text"):
            if own.by_piece:
                codes, bounds, values = pieces_of(batch.column("text"), CLASSES)
                sizes = np.fromiter(map(memo.__getitem__, values.to_pylist()), np.int64, len(values))
                n = np.diff(np.append(0, np.cumsum(sizes[codes]))[bounds])
            else:
                n = [len(own.library.encode(t, add_special_tokens=False).ids) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )

    kind = texts.schema["doc_id"].dataType.simpleString()
    return (
        texts.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
        .mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long")
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
