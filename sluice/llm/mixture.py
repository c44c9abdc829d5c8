"""Mixing sources to target shares by systematic sampling.

Within a source each document has the same expected number of copies.  Documents
stand in order of their size class, then of a hash; the running sum of expected
copies plus one random offset per source crosses an integer boundary once for
each copy emitted.  So the number of copies is the expected one to within one,
of each size class as well; tokens are the expected ones to within the largest
document of the source and the width of a class (4.4 %).  No document gets more than
max_repeats copies, and no random numbers are drawn per row.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.operators.ordinals import with_prefix
from sluice.session import materialise

#: A public byte-level BPE vocabulary in tiktoken's format, and the pattern of its pieces.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Size classes per doubling of a document's tokens, and hash buckets in each (a source has some hundred classes).
CLASSES, BUCKETS = 16, 64
# Fixed value: how the vocabulary's texts are cut into pieces.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def _encoding(path: str):  # noqa: ANN202
    import tiktoken

    if not os.path.exists(path):
        path = SparkFiles.get(os.path.basename(path))  # sent along with the job
    if not os.path.exists(path):
        import public_tokenizers  # where a cluster has the vocabularies as a package

        path = public_tokenizers.path(os.path.basename(path))
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(documents: DataFrame, id_: str = "doc_id", source: str = "source", text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """(document, source, tokens) per row; null text has 0 tokens.  The vocabulary's file is sent to the executors if the driver has it."""
    if os.path.exists(tokenizer):
        documents.sparkSession.sparkContext.addFile(tokenizer)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(tokenizer).encode_ordinary
        for batch in batches:
            n = [len(encode(t)) if t else 0 for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], ["document", "source", "tokens"])

    slim = documents.select(F.col(id_), F.col(source), F.col(text))
    return slim.mapInArrow(count, f"document {documents.schema[id_].dataType.simpleString()}, source string, tokens long")


def plan_mix(counts: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, max_repeats, tokens, total, copies): the expected copies of each document of a target source.

    The mix has the size of all documents together.  A null share counts as 0, a null cap as 1;
    sources without targets are not in the mix.
    """
    by_source = counts.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    total = counts.agg(F.coalesce(F.sum("tokens"), F.lit(0))).scalar()
    slim = targets.select("source", F.coalesce("target_share", F.lit(0.0)).alias("target_share"), F.coalesce("max_repeats", F.lit(1)).alias("max_repeats"))
    known = slim.join(by_source, "source", "left").withColumn("tokens", F.coalesce("tokens", F.lit(0).cast("long")))
    known = known.withColumn("total", total)
    wanted = F.when(F.col("tokens") > 0, F.col("target_share") * F.col("total") / F.col("tokens")).otherwise(0.0)
    return known.withColumn("copies", F.greatest(F.lit(0.0), F.least(F.col("max_repeats").cast("double"), wanted)))


def offset(source: Column, seed: int) -> Column:
    """One number in [0, 1) per source."""
    return F.pmod(F.xxhash64(source, F.lit(seed)), F.lit(1 << 32)) / float(1 << 32)


def sample(counts: DataFrame, plan: DataFrame, seed: int = 0) -> DataFrame:
    """(document, source, tokens, copies): each document of the mix with how many times it stands in it (1 or more).

    The same for the same documents and seed, however they are partitioned.  A document
    repeated in the input counts each time.
    """
    size = F.floor(F.log2(F.col("tokens") + 1.0) * CLASSES)
    placed = with_prefix(counts, "source", [F.col("document")], name="place", strata=size, buckets=BUCKETS)
    rated = placed.join(plan.select("source", F.col("copies").alias("rate")), "source")
    crossed = F.floor((F.col("place") + 1) * F.col("rate") + offset(F.col("source"), seed)) - F.floor(F.col("place") * F.col("rate") + offset(F.col("source"), seed))
    return rated.withColumn("copies", crossed.cast("int")).where("copies > 0").select("document", "source", "tokens", "copies")


def mix(documents: DataFrame, targets: DataFrame, seed: int = 0, tokenizer: str = TOKENIZER) -> tuple[DataFrame, DataFrame]:
    """The mix (see `sample`) and its report: source, target_share, max_repeats, tokens, target_tokens, mixed_tokens, actual_share, most_total, short.

    `short`: even at the cap the source stays below its share of the size of all documents.  What short sources lack makes
    the mix smaller, and the shares of the others larger; `most_total` is the largest mix in which the source keeps its share
    (null without a share), so the least of these is the largest mix in which all do.
    """
    counts = materialise(token_counts(documents, tokenizer=tokenizer), "token-counts")
    plan = materialise(plan_mix(counts, targets), "mix-plan")
    mixed = materialise(sample(counts, plan, seed), "mix")
    got = mixed.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("mixed_tokens"))
    size = mixed.agg(F.sum(F.col("tokens") * F.col("copies"))).scalar()
    report = plan.join(got, "source", "left").withColumn("size", size).withColumn("mixed_tokens", F.coalesce("mixed_tokens", F.lit(0).cast("long")))
    target = F.col("target_share") * F.col("total")
    # At the cap every document stands max_repeats times in the mix, so what was mixed is the most there can be.
    at_cap = (F.col("tokens") == 0) | (F.col("copies") >= F.col("max_repeats"))
    report = report.select(
        "source", "target_share", "max_repeats", "tokens", target.alias("target_tokens"), "mixed_tokens",
        F.coalesce(F.try_divide("mixed_tokens", "size"), F.lit(0.0)).alias("actual_share"),
        F.when(F.col("target_share") > 0, F.col("max_repeats") * F.col("tokens") / F.col("target_share")).alias("most_total"),
        ((F.col("target_share") > 0) & at_cap & (F.col("mixed_tokens") < target)).alias("short"),
    )
    return mixed, report
