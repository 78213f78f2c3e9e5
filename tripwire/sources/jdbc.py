"""Relational sink for the final table.

Rows are written with Spark's JDBC writer in batches of ``batchsize`` rows, into a staging table.
A streaming query calls :func:`jdbc_batch_writer` from ``foreachBatch``: every
row carries the streaming query's id and the micro-batch id. One transaction on a connection of the driver
then deletes what the final table has of these two ids, takes the staged rows over, and empties the
stage: readers of the final table see a micro-batch whole, before or after; a restart after a failure at any
step neither loses nor doubles rows; a query with another checkpoint leaves earlier rows alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import FINAL_COLUMNS

# Fixed value: the reference inserts 100 rows per batch.
BATCH_SIZE = 100

# Column types of the final table (VARCHAR(255) text, INT, DECIMAL(10,3)).
TABLE_DDL_COLUMNS = [
    ("transaction_id", "VARCHAR(255)"), ("user_id", "VARCHAR(255)"), ("txn_time", "BIGINT"),
    ("amount", "DECIMAL(10,3)"), ("location", "VARCHAR(255)"), ("transaction_type", "VARCHAR(255)"),
    ("fraud_score", "INT"), ("query_id", "VARCHAR(64)"), ("batch_id", "BIGINT"),
]

# Auto-numbered key clause per database (the id is given by the database).
IDENTITY = {
    "postgresql": "id SERIAL PRIMARY KEY",
    "derby": "id INT GENERATED ALWAYS AS IDENTITY PRIMARY KEY",
}


def _dialect(url: str) -> str:
    return url.split(":")[1]


def _execute(spark: SparkSession, url: str, props: dict, statements: list[str]) -> None:
    """Run the statements in one transaction: all of them take effect, or none does."""
    jvm = spark.sparkContext._jvm
    jprops = jvm.java.util.Properties()
    for k, v in props.items():
        if k not in ("driver", "batchsize"):
            jprops.setProperty(k, str(v))
    if "driver" in props:
        jvm.java.lang.Class.forName(props["driver"])
    conn = jvm.java.sql.DriverManager.getConnection(url, jprops)
    try:
        conn.setAutoCommit(False)
        try:
            for sql in statements:
                st = conn.createStatement()
                try:
                    st.execute(sql)
                finally:
                    st.close()
            conn.commit()
        except BaseException:
            conn.rollback()
            raise
    finally:
        conn.close()


def table_exists(spark: SparkSession, url: str, table: str, props: dict | None = None) -> bool:
    try:
        _execute(spark, url, props or {}, [f"SELECT COUNT(*) FROM {table} WHERE 1 = 0"])
    except Exception as e:  # noqa: BLE001
        if "SQL" not in str(e):
            raise
        return False
    return True


def stage_of(table: str) -> str:
    return f"{table}_stage"


def create_table(spark: SparkSession, url: str, table: str, props: dict | None = None, drop: bool = True) -> None:
    """Create the final table and its stage (A8): anew, or only what is missing with ``drop=False``."""
    props = props or {}
    cols = ", ".join(f"{c} {t}" for c, t in TABLE_DDL_COLUMNS)
    ident = IDENTITY.get(_dialect(url), IDENTITY["postgresql"])
    for name, columns in ((table, f"{ident}, {cols}"), (stage_of(table), cols)):
        there = table_exists(spark, url, name, props)
        if there and not drop:
            continue
        _execute(spark, url, props, ([f"DROP TABLE {name}"] if there else []) + [f"CREATE TABLE {name} ({columns})"])


def write_final(df: DataFrame, url: str, table: str, props: dict | None = None, batch_id: int | None = None,
                batch_size: int = BATCH_SIZE, query_id: str = "batch") -> None:
    """Append the 7 final columns (plus query and batch id) in JDBC batches of `batch_size` rows.

    Spark commits each task's rows alone, so on its own this is for tables that nobody reads meanwhile.
    """
    props = dict(props or {})
    props.setdefault("batchsize", str(batch_size))
    out = df.select(*FINAL_COLUMNS, F.lit(query_id).alias("query_id"), F.lit(batch_id).cast("long").alias("batch_id"))
    out.write.jdbc(url, table, mode="append", properties=props)


def _of_batch(query: str, batch_id: int) -> str:
    return f"query_id = '{query}' AND batch_id = {int(batch_id)}"


def swap_statements(table: str, query: str, batch_id: int) -> list[str]:
    """What takes a staged micro-batch over into the final table."""
    cols = ", ".join(c for c, _ in TABLE_DDL_COLUMNS)
    return [f"DELETE FROM {table} WHERE {_of_batch(query, batch_id)}",
            f"INSERT INTO {table} ({cols}) SELECT {cols} FROM {stage_of(table)} WHERE {_of_batch(query, batch_id)}",
            f"DELETE FROM {stage_of(table)} WHERE query_id = '{query}'"]


def jdbc_batch_writer(url: str, table: str, props: dict | None = None, batch_size: int = BATCH_SIZE):
    """``foreachBatch`` function: each micro-batch is flushed whole (A10), staged and then taken over in one transaction."""
    from ..streaming.stages import query_id

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, query = batch.sparkSession, query_id(batch)
        _execute(spark, url, props or {}, [f"DELETE FROM {stage_of(table)} WHERE query_id = '{query}'"])
        write_final(batch, url, stage_of(table), props, batch_id, batch_size, query)
        _execute(spark, url, props or {}, swap_statements(table, query, batch_id))
    return write


def read_table(spark: SparkSession, url: str, table: str, props: dict | None = None) -> DataFrame:
    return spark.read.jdbc(url, table, properties=dict(props or {}))


def final_count(spark: SparkSession, url: str, table: str, props: dict | None = None) -> DataFrame:
    """``select count(*)`` of the stored rows."""
    return read_table(spark, url, table, props).agg(F.count(F.lit(1)).alias("n"))
