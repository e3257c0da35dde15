"""Exact duplicates by splitting on successive bytes, most significant first.

The first digit of a text is its length in bytes together with its first ``FIRST_BYTES`` bytes, each later digit the next
``width`` bytes, where the width grows sixteenfold per level. A group with one member is done, and so is a group whose
texts have ended: members of a group have the same length, so they end together. Equality rests on the bytes alone.

Each level counts groups with a partial aggregate (a group that holds a third of all rows shrinks to one row per
map task) and writes the groups that go on. Members then meet their group in a join between two plain
tables, which adaptive execution can split where one group is large.

Defined cases: null text is empty; a null id counts as larger than any other; repeated rows (same id, same text) each count
in ``group_size`` and are marked alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.llm.storage import keep, row_label

FIRST_BYTES = 64
NEXT_BYTES = 4096
GROWTH = 16


def normalised(text: str | Column) -> Column:
    """Each run of the characters 0x20 and 0x09 to 0x0D becomes one blank; null becomes empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), "[\\x20\\x09-\\x0D]+", " ")


def _split(rows: DataFrame, digit: list[str], level: int) -> DataFrame:
    """The rows of every group that has two members at least, as ``label, length, group, size``.

    ``rows`` has a label, a length and the columns of ``digit``. A group is named by its smallest label.
    """
    groups = keep(
        rows.groupBy(*digit).agg(F.count(F.lit(1)).alias("size"), F.min("label").alias("new")).where("size > 1"),
        f"exact-groups-{level}",
    )
    known = groups.withColumnsRenamed({c: f"_{c}" for c in digit})
    same = [rows[c] == known[f"_{c}"] for c in digit]
    members = rows.join(known, same).select("label", rows["length"], F.col("new").alias("group"), "size")
    return keep(members.distinct(), f"exact-members-{level}")


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``label, group, size`` of each distinct row whose normalised text occurs at least twice.

    ``group`` is the label of the row that stays, ``size`` counts rows.
    """
    source = df.select(F.col(id_col).alias("id"), normalised(text_col).alias("text"))
    source = source.select(row_label("id", F.col("text")).alias("label"), F.col("text").cast("binary").alias("bytes"))
    first = source.select(
        "label", F.octet_length("bytes").alias("length"), F.substring("bytes", 1, FIRST_BYTES).alias("digit")
    )
    members = _split(first, ["length", "digit"], 0)
    reach, width, level = FIRST_BYTES, NEXT_BYTES, 1
    done = members.where(F.col("length") <= reach)
    longest = members.agg(F.max("length")).first()[0] or 0
    if longest > reach:
        # Only rows that share their first digit with another need their text; it is written once.
        # Texts meet the wanted labels in a merge join at every size: copies grow with the table, so a broadcast would not last.
        wanted = members.where(F.col("length") > reach).select(F.col("label").alias("_label"))
        texts = keep(source.join(wanted.hint("merge"), F.col("label") == F.col("_label")).drop("_label"), "exact-texts")
    while longest > reach:
        going = members.where(F.col("length") > reach).select(F.col("label").alias("_label"), "length", "group")
        slices = texts.select("label", F.substring("bytes", reach + 1, width).alias("digit"))
        rows = slices.join(going, F.col("label") == F.col("_label")).drop("_label")
        members = _split(rows, ["group", "digit"], level)
        reach, width, level = reach + width, width * GROWTH, level + 1
        done = done.unionByName(members.where(F.col("length") <= reach))
        longest = members.agg(F.max("length")).first()[0] or 0
    return done.select("label", "group", "size")


def mark_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``df`` and a struct ``copies``: ``keep_id, group_size, kept, text_sha256``.

    ``kept`` is true for the row with the smallest id of its group and for rows without a copy.
    """
    text = normalised(text_col)
    groups = exact_groups(df, id_col, text_col).withColumnsRenamed({"label": "_label", "group": "_group", "size": "_size"})
    marked = df.withColumns({"_own": row_label(id_col, text), "_sha": F.sha2(text.cast("binary"), 256)})
    marked = marked.join(groups, F.col("_own") == F.col("_label"), "left")
    alone = F.col("_group").isNull()
    keep_id = F.when(alone, F.col(id_col)).otherwise(F.col("_group.id"))
    copies = F.struct(
        keep_id.alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | F.col(id_col).eqNullSafe(F.col("_group.id"))).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )
    return marked.withColumn("copies", copies).drop("_own", "_sha", "_label", "_group", "_size")


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of equal texts, with the columns of ``df``.

    Of repeated rows (same id and text) one stays as well: only rows of groups are looked at for that.
    """
    names = df.columns
    held = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    marked = mark_copies(held, "_id", "_text").where("copies.kept")
    single = marked.where("copies.group_size = 1")
    several = marked.where("copies.group_size > 1").dropDuplicates(["_id", "_text"])
    return single.unionByName(several).select("row.*")
