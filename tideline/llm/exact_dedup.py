"""Exact de-duplication as a tree merge of digest runs.

Every input partition turns its rows into a run: one entry per digest with the
identifiers that carry it. In each round the owners of ``fan_in`` runs exchange
parts of them, as in a binomial tree whose nodes have ``fan_in`` children: the
owner whose r-th digit is d receives the entries whose digest has r-th digit d.
It sorts what it received, which merges the runs, and keeps one entry per digest:
the best identifier and the number of rows. After ceil(log(partitions, fan_in))
rounds every digest has one owner. A digest with a third of all rows is one entry
per run from the first level on, so no owner receives more of it than ``fan_in``
entries in a round.

Runs are ordered by a 64-bit hash; two entries are merged only if their SHA-256
and byte length are equal too, at every level.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import partitions, stored, whole

KEY = ["prefix", "digest", "bytes"]
#: Column that tells the texts of one identifier apart.
TEXT_KEY = "tideline_text_key"


def _ranked(keep: str, ident: Column) -> Column:
    """Orders identifiers so that the greatest stays; a null only if there is no other."""
    known = ident.isNotNull() if keep == "max" else ident.isNull()
    return F.struct(known.alias("known"), ident.alias("id"), F.col("part").alias("part"))


def owners_of(tasks: int, fan_in: int) -> tuple[int, int]:
    """(rounds, owners): the smallest tree with at least as many owners as tasks."""
    rounds = max(1, math.ceil(math.log(max(tasks, 2), fan_in) - 1e-9))
    return rounds, fan_in**rounds


def merge_runs(
    rows: DataFrame, keep: str, fan_in: int = 4, carried: str | None = None
) -> DataFrame:
    """The tree merge. ``rows`` has part, id and the key (prefix, digest, bytes).

    Result, a row for each: part, id, the key, best (struct with the id that stays), n, kept
    and, if named, a column of ``rows`` that is carried along.
    """
    also = [carried] if carried else []
    spark = rows.sparkSession
    best = F.max if keep == "max" else F.min
    best_of = F.array_max if keep == "max" else F.array_min
    tasks = partitions(spark)
    rounds, owners = owners_of(tasks, fan_in)
    # One row per digest and input partition, with the identifiers of that partition.
    leaves = stored(
        rows.withColumn("part", F.pmod("part", F.lit(owners)).cast("int"))
        .groupBy("part", *KEY)
        .agg(F.sort_array(F.collect_list(F.struct("id", *also))).alias("ids")),
        "digest-runs",
    )
    runs = leaves.select(
        "part",
        *KEY,
        best_of(F.transform("ids", lambda x: _ranked(keep, x["id"]))).alias("best"),
        F.size("ids").cast("long").alias("n"),
    )
    owner = F.pmod("prefix", F.lit(owners)).cast("int")
    for r in range(rounds):
        place = fan_in**r
        digit = F.floor(owner / place) % fan_in
        mine = F.floor(F.col("part") / place) % fan_in
        runs = (
            runs.withColumn("part", (F.col("part") + (digit - mine) * place).cast("int"))
            .repartitionById(tasks, F.col("part"))
            .sortWithinPartitions("part", *KEY)
            .groupBy("part", *KEY)
            .agg(best("best").alias("best"), F.sum("n").alias("n"))
        )
    verdicts = runs.drop("part")
    # The verdicts go back down: first to the run entries, then to their identifiers, so
    # that the members of a group are never gathered.
    entries = leaves.select("part", *KEY).join(verdicts, KEY)
    member = F.col("member")
    first = F.array_position("ids", member)
    if carried:
        first = F.array_position(
            F.transform("ids", lambda x: F.struct(x["id"])), F.struct(F.col("member.id"))
        )
    return (
        leaves.join(entries, ["part", *KEY])
        .select("part", *KEY, "best", "n", "ids", F.posexplode("ids").alias("at", "member"))
        .select(
            "part",
            F.col("member.id").alias("id"),
            *KEY,
            "best",
            "n",
            (
                F.col("member.id").eqNullSafe(F.col("best.id"))
                & (F.col("part") == F.col("best.part"))
                & (F.col("at") + 1 == first)
            ).alias("kept"),
            *(F.col(f"member.{name}") for name in also),
        )
    )


def exact_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "max",
    fan_in: int = 4,
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal if their bytes are. Of equal texts the largest identifier stays
    (``keep="min"``: the smallest). Defined cases: a null text counts as empty; a
    null identifier stays only if its group has no other; of repeated rows (same
    identifier and text) one is kept and all count in ``group_size``; an empty table
    gives no rows. Other columns of ``docs`` are not read, whatever their names.
    """
    if keep not in ("max", "min"):
        raise ValueError(f"Unknown rule: {keep}")
    rows = docs.select(
        F.spark_partition_id().alias("part"),
        F.col(id_col).alias("id"),
        whole(text_col).alias("body"),
    ).select(
        "part",
        "id",
        F.xxhash64("body").alias("prefix"),
        F.unhex(F.sha2("body", 256)).alias("digest"),
        F.octet_length("body").cast("long").alias("bytes"),
    )
    return merge_runs(rows, keep, fan_in).select(
        F.col("id").alias(id_col),
        F.col("best.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_rows(
    docs: DataFrame,
    kept: DataFrame,
    keyed: Callable[[DataFrame, str], DataFrame],
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that ``kept`` lists, with all their columns.

    ``kept`` has identifier and TEXT_KEY, one row per row that stays; ``keyed`` adds that
    column to rows, from their text column. Rows that repeat an identifier are rare: those are
    found by identifier and key and cut to one for each in a branch of their own, so that no
    text is shuffled or keyed for the others. The columns of ``docs`` go by position, so
    their names don't matter.
    """
    names = docs.columns
    docs = docs.toDF(*(f"c{i}" for i in range(len(names))))
    ident, text = f"c{names.index(id_col)}", f"c{names.index(text_col)}"
    ids = kept.select(F.col(id_col).alias("kept_id"), F.col(TEXT_KEY).alias("kept_key"))
    twice = (
        docs.groupBy(F.col(ident).alias("twice_id"))
        .agg(F.count(F.lit(1)).alias("times"))
        .filter("times > 1")
        .select("twice_id")
    )
    repeats = F.col("kept_id").eqNullSafe(F.col("twice_id"))
    once = ids.join(twice, repeats, "left_anti").select("kept_id")
    again = ids.join(twice, repeats, "left_semi")
    rows = keyed(docs.join(twice, docs[ident].eqNullSafe(F.col("twice_id")), "left_semi"), text)
    same = rows[ident].eqNullSafe(F.col("kept_id")) & (rows[TEXT_KEY] == F.col("kept_key"))
    return (
        docs.join(once, docs[ident].eqNullSafe(F.col("kept_id")), "left_semi")
        .unionByName(
            rows.join(again, same, "left_semi").dropDuplicates([ident, TEXT_KEY]).drop(TEXT_KEY)
        )
        .toDF(*names)
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns, whatever these are named.

    As in ``exact_classes`` a null text counts as empty, of repeated rows one stays, a null
    identifier stays only if its text has no other, and an empty table gives no rows.
    """
    kept = exact_classes(docs, id_col, text_col).filter("kept")
    return keep_rows(
        docs,
        kept.withColumnRenamed("text_sha256", TEXT_KEY),
        lambda rows, text: rows.withColumn(TEXT_KEY, F.sha2(whole(text), 256)),
        id_col,
        text_col,
    )
