"""Text encoding: tokens, a frequency-ranked vocabulary, fixed-length ids.

The WordPiece tokenizer is replaced by lower-cased letter runs, computed by
JVM regex functions. Token -> id lookup happens inside the row, against a
packed perfect hash of the vocabulary that is sent once (salted shuffle join
for a vocabulary beyond its size bound).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.labels import HEAD_TOKENS, MAX_LENGTH, SPECIAL_TOKENS, TAIL_TOKENS
from lectern.operators.joins import lookup_join
from lectern.operators.numbering import global_row_number
from lectern.operators.packed_vocab import MAX_WORDS, pack_vocab, token_ids
from lectern.operators.sizing import stable_table

PAD_ID, UNK_ID, CLS_ID, SEP_ID = 0, 1, 2, 3
# A vocabulary of up to this many words is sent to the tasks in packed form; a larger one is joined by a salted shuffle.
PACKED_WORDS = MAX_WORDS
TOKEN_PATTERN = r"[^\p{L}]+"


def tokens(col: Column | str) -> Column:
    """Lower-cased runs of letters; empty pieces dropped."""
    c = F.col(col) if isinstance(col, str) else col
    # array_remove is compiled; a filter lambda would run interpreted per element
    return F.array_remove(F.split(F.lower(c), TOKEN_PATTERN, -1), "")


def tokenize(df: DataFrame, text_col: str = "text", out_col: str = "tokens") -> DataFrame:
    return df.withColumn(out_col, tokens(text_col))


def build_vocab(train: DataFrame, text_col: str = "text", min_count: int = 1) -> DataFrame:
    """(token, token_id, n): ids by frequency desc then token, after the
    reserved PAD/UNK/CLS/SEP ids. Counting is map-side combined, so a hot
    token costs one partial count per task."""
    counts = (train.select(F.explode(tokens(text_col)).alias("token"))
              .groupBy("token").agg(F.count(F.lit(1)).alias("n"))
              .where(F.col("n") >= min_count))
    # the token counts are written once: the numbering's size check and the
    # numbering itself then read the table instead of re-counting all tokens
    counts = stable_table(counts, "token-counts")
    ranked = global_row_number(counts, [F.col("n").desc(), F.col("token").asc()], "_r")
    return ranked.select("token", (F.col("_r") + len(SPECIAL_TOKENS) - 1).cast("bigint").alias("token_id"), "n")


def join_vocab(df: DataFrame, vocab: DataFrame, key_col: str = "doc_id", tokens_col: str = "tokens") -> DataFrame:
    """(key, pos, token, token_id): unknown tokens map to UNK. Ids are looked up inside the row; a vocabulary that is too
    large to be sent is joined by a salted shuffle."""
    packed = pack_vocab(vocab, PACKED_WORDS)
    if packed is not None:
        ids = token_ids(df, packed, F.col(tokens_col), UNK_ID)
        zipped = df.select(key_col, F.posexplode(F.arrays_zip(F.col(tokens_col).alias("token"), ids.alias("token_id"))).alias("pos", "_t"))
        return zipped.select(key_col, "pos", F.col("_t")["token"].alias("token"), F.col("_t")["token_id"].alias("token_id"))
    exploded = df.select(key_col, F.posexplode(tokens_col).alias("pos", "token"))
    j = lookup_join(exploded, vocab.select("token", "token_id"), "token", "left", salt_source=key_col)
    return j.select(key_col, "pos", "token", F.coalesce("token_id", F.lit(UNK_ID)).cast("bigint").alias("token_id"))


def _ids_per_doc(df: DataFrame, vocab: DataFrame, key_col: str, tokens_col: str, kept: Column | None = None) -> DataFrame:
    """(key, n_tokens, ids) with ``ids`` the vocabulary ids of the ``kept`` tokens
    (default all) in order. ``n_tokens`` always counts the whole text.

    A projection where the vocabulary can be sent. Beyond that ``posexplode_outer`` keeps token-less documents, so no join
    back to the documents is needed; the per-document list is bounded by the kept tokens.
    """
    kept = F.col(tokens_col) if kept is None else kept
    packed = pack_vocab(vocab, PACKED_WORDS)
    if packed is not None:
        return df.select(key_col, F.size(tokens_col).alias("n_tokens"), token_ids(df, packed, kept, UNK_ID).alias("ids"))
    exploded = df.select(key_col, F.size(tokens_col).alias("n_tokens"),
                         F.posexplode_outer(kept).alias("pos", "token"))
    j = lookup_join(exploded, vocab.select("token", "token_id"), "token", "left", salt_source=key_col)
    item = F.struct("pos", F.coalesce("token_id", F.lit(UNK_ID)).cast("bigint").alias("token_id"))
    per_doc = j.groupBy(key_col, "n_tokens").agg(
        F.sort_array(F.collect_list(F.when(F.col("pos").isNotNull(), item))).alias("_p"))
    return per_doc.select(key_col, "n_tokens", F.transform("_p", lambda s: s["token_id"]).alias("ids"))


def _frame(ids: Column, max_length: int) -> list[Column]:
    body = F.concat(F.array(F.lit(CLS_ID).cast("bigint")), ids, F.array(F.lit(SEP_ID).cast("bigint")))
    pad = F.array_repeat(F.lit(PAD_ID).cast("bigint"), F.lit(max_length) - F.size(body))
    input_ids = F.concat(body, pad)
    mask = F.concat(F.array_repeat(F.lit(1).cast("bigint"), F.size(body)),
                    F.array_repeat(F.lit(0).cast("bigint"), F.lit(max_length) - F.size(body)))
    return [input_ids.alias("input_ids"), mask.alias("attention_mask")]


def encode_truncate_pad(df: DataFrame, vocab: DataFrame, max_length: int = MAX_LENGTH,
                        key_col: str = "doc_id", tokens_col: str = "tokens") -> DataFrame:
    """CLS + tokens + SEP, cut on the right to ``max_length``, padded, with mask."""
    # only the first max_length - 2 tokens can reach the output
    per = _ids_per_doc(df, vocab, key_col, tokens_col, F.slice(tokens_col, 1, max_length - 2))
    return per.select(key_col, "n_tokens", *_frame(F.col("ids"), max_length))


def head_tail(ids: Column, head: int = HEAD_TOKENS, tail: int = TAIL_TOKENS) -> Column:
    """Keep first ``head`` + last ``tail`` ids when longer than head + tail."""
    n = F.size(ids)
    return F.when(n > head + tail, F.concat(F.slice(ids, 1, head), F.slice(ids, -tail, tail))).otherwise(ids)


def encode_head_tail(df: DataFrame, vocab: DataFrame, max_length: int = MAX_LENGTH,
                     head: int = HEAD_TOKENS, tail: int = TAIL_TOKENS,
                     key_col: str = "doc_id", tokens_col: str = "tokens") -> DataFrame:
    if head + tail != max_length - 2:
        raise ValueError("head + tail must equal max_length - 2")
    # only the head and tail positions can reach the output
    per = _ids_per_doc(df, vocab, key_col, tokens_col, head_tail(F.col(tokens_col), head, tail))
    return per.select(key_col, "n_tokens", *_frame(F.col("ids"), max_length))


def pad_to_batch_max(encoded: DataFrame, batch_size: int, max_length: int = MAX_LENGTH,
                     key_col: str = "doc_id", len_col: str = "n_tokens") -> DataFrame:
    """Width of each row = longest row of its mini-batch (+CLS/SEP), capped.

    The window is per mini-batch, i.e. ``batch_size`` rows at most.
    """
    numbered = global_row_number(encoded, [F.col(key_col).asc()], "_rn")
    b = numbered.withColumn("batch", F.floor((F.col("_rn") - 1) / batch_size).cast("bigint"))
    width = F.least(F.max(F.col(len_col) + 2).over(Window.partitionBy("batch")), F.lit(max_length))
    return b.withColumn("padded_len", width.cast("bigint")).drop("_rn")
