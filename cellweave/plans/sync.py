"""Two-way file sync: what to do follows from one full outer join of two listings (name, mtime, md5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.plans.store import Place, Store, under

POLICIES = ("ignore", "newer", "different", "force")
#: Seconds by which times may differ and still count as equal.
TOLERANCE = 5.0
LISTING = "name string, mtime double, md5 string"


def reconcile(local: DataFrame, remote: DataFrame, policy: str = "ignore") -> DataFrame:
    """``name, action``: ``upload``, ``download`` or ``skip``.

    ignore: upload what the store lacks. newer: bring the later version to the other side, and what one side lacks.
    different: upload what is missing or differs by digest. force: upload everything.
    """
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy!r}; known: {', '.join(POLICIES)}")
    a = local.select("name", F.col("mtime").alias("here"), F.col("md5").alias("md5_here"))
    b = remote.select("name", F.col("mtime").alias("there"), F.col("md5").alias("md5_there"))
    both = a.join(b, "name", "full_outer")
    lacks, ahead = F.col("there").isNull(), F.col("here") - F.col("there")
    upload = {
        "ignore": lacks,
        "newer": lacks | (ahead > TOLERANCE),
        "different": lacks | (F.col("md5_here") != F.col("md5_there")),
        "force": F.lit(True),
    }[policy]
    here = F.col("here").isNotNull()
    down = (~here | (ahead < -TOLERANCE)) if policy == "newer" else F.lit(False)
    return both.select("name", F.when(here & upload, "upload").when(down, "download").otherwise("skip").alias("action"))


def sync(spark: SparkSession, root: Place, remote: Place, policy: str = "ignore") -> dict[str, str]:
    """Carries the actions out between two folders of any stores; a copy gets the time of what it was copied from.

    Both are listed by Spark, with digests made in tasks; names and actions reach the driver, and files are streamed by its JVM.
    """
    store = Store(spark)
    actions = reconcile(store.listing(root), store.listing(remote), policy).orderBy("name").collect()
    for r in actions:
        here, there = under(root, r["name"]), under(remote, r["name"])
        if r["action"] == "upload":
            store.copy(here, there, store.modified(here))
        elif r["action"] == "download":
            store.copy(there, here, store.modified(there))
    return {r["name"]: r["action"] for r in actions}
