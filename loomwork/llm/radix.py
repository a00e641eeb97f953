"""Exact duplicates by distributed MSD radix partitioning.

Documents are split by successive runs of bytes: each level reads the next bytes of the documents that
still share everything before, and splits their groups by them. A group ends when it is a single document
or when its texts have ended; equality is decided by the bytes, no digest takes part. The runs grow
(32 bytes, then up to offset 128, 512, ...), so a text of n bytes needs about log4(n / 32) levels and every
byte moves once at most. A level is an aggregate (combined on the map side, so thousands of copies send one
row a task) and a join. A run of bytes that more than one in HOT of all rows share is hot; there are fewer than HOT
such at a level, so every task knows them, and their rows are dealt over SPREAD keys each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, forget, written

#: A key that more than one in so many rows share is hot: at most so many keys are.
HOT = 256
#: So many tasks take a hot key's rows.
SPREAD = 64
#: Longer runs of bytes aren't sent to all tasks (HOT of them are 16 MB at most); adaptive execution splits their joins.
LONGEST = 1 << 16


def _joined(rows: DataFrame, counts: DataFrame, keys: list[str], row_number: Column, total: int, how: str) -> DataFrame:
    """`rows` joined to `counts` (keys, n, ...; each key once) by `keys`; the rows of a hot key meet in SPREAD places."""
    hot = counts.where((F.col("n") > total // HOT) & (F.length("digit") <= LONGEST)).select(*keys, F.lit(True).alias("hot"))
    dealt = rows.join(F.broadcast(hot), keys, "left").withColumn("place", F.when(F.col("hot"), F.pmod(F.xxhash64(row_number), F.lit(SPREAD))).otherwise(0).cast("int")).drop("hot")
    spread = (F.col("n") > total // HOT) & (F.length("digit") <= LONGEST)
    copied = counts.withColumn("place", F.explode(F.when(spread, F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0)))))
    return dealt.join(copied.hint("merge"), [*keys, "place"], how).drop("place")


def radix_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None, first: int = 32, factor: int = 4) -> DataFrame:
    """One row for each row of `docs`: row struct<carried columns>, id, keep_id, group_size, kept.

    Of equal texts the row with the largest id stays; of rows that tie in id and text one stays. A null text
    equals the empty text. A null id is less than any other. An empty table gives an empty result. `carry`:
    the columns returned in `row` (all by default); they never meet the names used here.
    """
    names = docs.columns if carry is None else carry
    # The bytes are read from the carried text, or from a column of their own, kept while a row is open.
    carried = text_col in names
    text = F.col("row").getField(text_col) if carried else F.col("body")
    body = F.coalesce(text.cast("binary"), F.lit(bytearray()))
    own = [] if carried else ["body"]
    base = docs.select(F.struct(*[col(c) for c in names]).alias("row"), col(id_col).alias("id"), *([] if carried else [col(text_col).cast("binary").alias("body")]))
    digit = F.substring(body, 1, first)
    # Written first, the counts are joined by exchanges of their own.
    counts = written(base.groupBy(digit.alias("digit")).agg(F.count("*").alias("n")), "radix-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    shared = counts.where("n > 1").withColumn("gid", F.lit(0).cast("bigint"))
    at = written(_joined(base.withColumn("digit", digit), shared, ["digit"], F.monotonically_increasing_id(), total, "left").select("row", "id", F.monotonically_increasing_id().alias("rid"), *[F.when(F.col("gid").isNotNull(), F.col(c)).alias(c) for c in own], "gid"), "radix")
    forget(counts)
    one = F.lit(1).cast("bigint")
    done = [at.where("gid is null").select("row", "id", F.col("id").alias("keep_id"), one.alias("group_size"), F.lit(True).alias("kept"))]
    live, offset, end = at.where("gid is not null"), 0, first * factor  # one group as yet: the first bytes are read again
    while not live.isEmpty():
        keyed = live.select("row", "id", "rid", *own, "gid", F.substring(body, offset + 1, end - offset).alias("digit"), (F.length(body) > end).alias("more"))
        split = written(keyed.groupBy("gid", "digit", "more").agg(F.count("*").alias("n"), F.min("rid").alias("next"), F.max(F.struct("id", "rid")).alias("best")), "radix-counts")
        open_ = (F.col("n") > 1) & F.col("more")
        at = written(
            _joined(keyed, split, ["gid", "digit", "more"], F.col("rid"), total, "inner").select("row", "id", "rid", *[F.when(open_, F.col(c)).alias(c) for c in own], F.when(open_, F.col("next")).alias("gid"), F.when(~open_, F.col("n")).alias("n"), F.when(~open_, F.col("best")).alias("best")),
            "radix",
        )
        forget(split)
        done.append(at.where("gid is null").select("row", "id", F.col("best.id").alias("keep_id"), F.col("n").alias("group_size"), (F.col("rid") == F.col("best.rid")).alias("kept")))
        live, offset, end = at.where("gid is not null").select("row", "id", "rid", *own, "gid"), end, end * factor
    out = done[0]
    for part in done[1:]:
        out = out.unionAll(part)
    return out


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row; see radix_groups for ties, nulls and empty tables."""
    own = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"), F.sha2(F.coalesce(col(text_col), F.lit("")).cast("binary"), 256).alias("text_sha256"))
    g = radix_groups(own, carry=["text_sha256"])
    return g.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("row.text_sha256").alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns: of equal texts (a null one is empty) the row with the largest id, of rows that tie in id one; null ids are less than others. Texts of any length are read; an empty table gives no rows."""
    g = radix_groups(docs, id_col, text_col)
    return g.where("kept").select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
