"""The compacted store: batches, levels, a conditional write that is partly refused, and a writer who comes too late."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripweave.session import work_folder
from tripweave.sources.store import Conflict, Store
from tripweave.workloads.registry import query

# Shipments as upserts in ten batches; some remove their key.
_SHIPPED = """
    SELECT concat('CITY#', cast(l_suppkey AS string)) AS PK, concat('ITEM#', cast(l_partkey AS string)) AS SK,
      cast(l_orderkey % 10 + 1 AS int) AS batch, l_orderkey, l_linenumber, l_quantity AS quantity, l_linestatus AS flag,
      l_returnflag = 'R' AND l_linenumber = 1 AS gone
    FROM {lineitem}"""


@query(f"""
    WITH shipped AS ({_SHIPPED})
    SELECT PK, SK, quantity, flag, l_orderkey, l_linenumber FROM (
      SELECT *, row_number() OVER (PARTITION BY PK, SK ORDER BY batch DESC, l_orderkey DESC, l_linenumber DESC) AS i FROM shipped) x
    WHERE i = 1 AND NOT gone""")
def store_batches(t):
    """Ten batches of upserts and deletions, merged by levels, compacted once half way: the current items."""
    store = Store(t.spark, work_folder(t.spark, "store"), buckets=8, fan=3)
    rows = t.sql(_SHIPPED)
    for batch in range(1, 11):
        own = rows.where(F.col("batch") == batch).drop("batch")
        store.append(own, batch, ["l_orderkey", "l_linenumber"], F.col("gone"))
        store.tidy()
        if batch == 5:
            store.compact()
    return store.current().select("PK", "SK", "quantity", "flag", "l_orderkey", "l_linenumber")


_ACCOUNTS = """
    SELECT 'ACCOUNT' AS PK, s_name AS SK, s_acctbal AS balance, s_nationkey AS nation, cast(NULL AS bigint) AS expected_version FROM {supplier}"""


def _accounts(t):
    """All suppliers stored, then a change of each: those of nations below 10 know the stored version, others an older one."""
    store = Store(t.spark, work_folder(t.spark, "store"), buckets=4)
    accounts = t.sql(_ACCOUNTS)
    store.write_if(accounts, 1)
    store.compact()
    read = store.manifest()
    changed = accounts.withColumn("balance", F.col("balance") + 1).withColumn(
        "expected_version", F.when(F.col("nation") < 10, 1).when(F.col("nation") < 20, 0).cast("long")
    )
    store.write_if(changed, 2, since=read.version)
    try:  # a writer who has read the version before
        store.write_if(accounts, 3, since=read.version)
    except Conflict:
        return store
    raise RuntimeError("the late writer was not refused")


@query("""
    SELECT s_name AS SK, CASE WHEN s_nationkey < 10 THEN s_acctbal + 1 ELSE s_acctbal END AS balance, s_nationkey AS nation,
      CASE WHEN s_nationkey < 10 THEN 2 ELSE 1 END AS row_version FROM {supplier}""")
def store_conditional(t):
    """Accounts after a conditional write and a refused late writer."""
    return _accounts(t).current().select("SK", "balance", "nation", F.col("row_version").cast("int").alias("row_version"))


@query("""
    SELECT s_name AS SK, 'balance' AS field, CASE WHEN s_nationkey < 20 THEN 0 ELSE -1 END AS expected_version, 1 AS found_version
    FROM {supplier} WHERE s_nationkey >= 10""")
def store_history(t):
    """Change candidates of the rows whose version had moved on."""
    return _accounts(t).history().select(
        "SK", "field", F.coalesce("expected_version", F.lit(-1)).cast("int").alias("expected_version"), F.col("found_version").cast("int").alias("found_version")
    )
