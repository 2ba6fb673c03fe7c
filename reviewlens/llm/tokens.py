"""Token counts through a digest cache.

A text's digest and the digest of the tokenizer's file name a stored count. Texts are joined to the cache by
them; of the texts it lacks, one row per distinct digest is encoded, and the new counts are appended.
Copies and later runs cost a join instead of an encoding. A changed tokenizer file is another version.

Inside a task the library encodes each distinct piece once: a byte-level tokenizer that splits by the common
pattern never merges across the blank before a word, so a text's count is the sum over its pieces. Texts
with white space beyond ASCII or with strings of special tokens go through the library whole.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Callable, Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import join_hot, ship, slices, stored, table
from .registry import QUERIES

ship(__name__)

LIMIT = 512
MEMO = 600_000  # pieces remembered by a task before it starts afresh
CACHE = "tokenizer string, content string, n_tokens long"
PIECE = re.compile(r" ?[^ \t-\r]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+")
OTHER_SPACE = r"\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f\u2060\u3000\ufeff"


def _by_pieces(config: dict) -> bool:
    split = config.get("pre_tokenizer") or {}
    return (
        config.get("normalizer") is None and split.get("type") == "ByteLevel"
        and split.get("use_regex") is True and not split.get("add_prefix_space")
        and config["model"].get("type", "BPE") == "BPE" and not config["model"].get("dropout")
    )


def counter(name: str, content: bytes) -> Callable[[list[str]], list[int]]:
    """A function that counts the tokens of texts as the library for this file gives them, without added tokens."""
    if name.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_proto=content)
        return lambda texts: [len(ids) for ids in pieces.encode(texts, num_threads=1)]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(content.decode())
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def whole(texts: list[str]) -> list[int]:
        return [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    config = json.loads(content)
    if not _by_pieces(config):
        return whole
    special = [re.escape(t["content"]) for t in config.get("added_tokens", [])]
    odd = re.compile("|".join([f"[{OTHER_SPACE}]", *special]))
    memo: dict[str, int] = {}

    def count(texts: list[str]) -> list[int]:
        out = []
        for text in texts:
            if odd.search(text):
                out += whole([text])
                continue
            pieces = PIECE.findall(text)
            try:
                out.append(sum(map(memo.__getitem__, pieces)))
            except KeyError:
                fresh = [p for p in set(pieces) if p not in memo]
                if len(memo) + len(fresh) > MEMO:
                    memo.clear()
                    fresh = list(set(pieces))
                memo.update(zip(fresh, whole(fresh), strict=True))
                out.append(sum(map(memo.__getitem__, pieces)))
        return out

    return count


def read_cache(spark: SparkSession, cache: str) -> DataFrame:
    """The stored counts; none where the folder does not exist yet."""
    try:
        return spark.read.schema(CACHE).parquet(cache)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in (e.getCondition() or ""):
            raise
        return spark.createDataFrame([], CACHE)


def count_tokens(docs: DataFrame, tokenizer: str, cache: str, doc_id: str = "doc_id", text: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row per row of ``docs``; fills the cache on the way.

    ``tokenizer`` is the path of a tokenizer file that the driver can read. The whole text counts, in UTF-8
    bytes and in tokens without begin, end or added tokens; strings of special tokens in a text count
    as the library handles them by default. NULL is ''. Repeated rows and copies are encoded
    once. Other columns are not returned. An empty table gives no rows and adds nothing to the cache.
    """
    spark = docs.sparkSession
    with open(tokenizer, "rb") as file:
        content = file.read()
    version = hashlib.sha256(content).hexdigest()
    file_name = os.path.basename(tokenizer)
    shared = spark.sparkContext.broadcast(content)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(file_name, shared.value)
        for batch in batches:
            for part in slices(batch, "text"):
                counts = count(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("content"), pa.array(counts, pa.int64())], names=["content", "n_tokens"])

    normal = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(
        F.col(doc_id).alias("doc_id"), F.octet_length(normal).cast("long").alias("n_bytes"), F.sha2(normal, 256).alias("content")
    )
    wanted = stored(keyed.groupBy("content").agg(F.min("doc_id").alias("holder"), F.count(F.lit(1)).alias("rows")), "contents")
    known = read_cache(spark, cache).where(F.col("tokenizer") == version)
    misses = wanted.join(known, "content", "left_anti").select(F.col("content").alias("missing"), "holder")
    # one document per missing digest; the key holds the id, so that copies of one text do not meet
    texts = docs.select(F.col(doc_id).alias("id"), F.sha2(normal, 256).alias("content"), normal.alias("text")).join(
        misses.hint("shuffle_hash"), (F.col("content") == F.col("missing")) & F.col("id").eqNullSafe(F.col("holder"))
    )
    fresh = texts.select("content", "text").mapInArrow(encode, "content string, n_tokens long")
    fresh = fresh.dropDuplicates(["content"]).select(F.lit(version).alias("tokenizer"), "content", "n_tokens")
    fresh.write.mode("append").parquet(cache)
    counts = read_cache(spark, cache).where(F.col("tokenizer") == version).select("content", "n_tokens")
    counted = stored(wanted.select("content", "rows").join(counts.dropDuplicates(["content"]), "content"), "counts")
    return join_hot(keyed, counted, ["content"], "rows", "doc_id").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document; the cache is a new one for each call, so that the query's work does not depend on earlier runs."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return count_tokens(table(spark, sf_dir, "documents"), path, scratch_dir(spark, "token-cache"))


QUERIES["op10_token_counts"] = op10_token_counts
