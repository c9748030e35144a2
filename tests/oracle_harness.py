"""Side-by-side check of a Spark query against its DuckDB oracle SQL.

Compares row count, column names + type family, and an order-insensitive hash
of the values (columns sorted by name), as the driver's correctness gate does.
"""

from __future__ import annotations

import datetime
import decimal
import hashlib

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

SPARK_FAMILY = {
    "IntegerType": "int", "LongType": "bigint", "ShortType": "int", "ByteType": "int",
    "DoubleType": "double", "FloatType": "double", "StringType": "string", "BooleanType": "bool",
    "TimestampType": "timestamp", "TimestampNTZType": "timestamp", "DateType": "date",
}
DUCK_FAMILY = {
    "INTEGER": "int", "BIGINT": "bigint", "SMALLINT": "int", "TINYINT": "int", "DOUBLE": "double",
    "FLOAT": "double", "VARCHAR": "string", "BOOLEAN": "bool", "TIMESTAMP": "timestamp", "DATE": "date",
    "HUGEINT": "hugeint",
}


def duck_connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return repr(v)


def _hash(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    digests = sorted(hashlib.sha1("|".join(_norm(r[i]) for i in order).encode()).hexdigest() for r in rows)
    return hashlib.sha1("".join(digests).encode()).hexdigest()


def compare(spark_df, con, sql: str) -> dict:
    s_rows = [tuple(r) for r in spark_df.collect()]
    s_names = spark_df.columns
    s_types = [SPARK_FAMILY.get(type(f.dataType).__name__, type(f.dataType).__name__) for f in spark_df.schema.fields]
    cur = con.execute(sql)
    d_names = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    d_types = [DUCK_FAMILY.get(str(d[1]).split("(")[0], str(d[1])) for d in cur.description]
    out = {
        "rows_spark": len(s_rows), "rows_oracle": len(d_rows),
        "names_match": sorted(s_names) == sorted(d_names),
        "types_match": sorted(zip(s_names, s_types)) == sorted(zip(d_names, d_types)),
    }
    out["hash_match"] = out["names_match"] and _hash(s_rows, s_names) == _hash(d_rows, d_names)
    out["ok"] = out["rows_spark"] == out["rows_oracle"] and out["types_match"] and out["hash_match"]
    if not out["ok"]:
        out["spark_schema"] = list(zip(s_names, s_types))
        out["oracle_schema"] = list(zip(d_names, d_types))
        s_set = {tuple(_norm(r[s_names.index(n)]) for n in sorted(s_names)) for r in s_rows}
        d_set = {tuple(_norm(r[d_names.index(n)]) for n in sorted(d_names)) for r in d_rows} if out["names_match"] else set()
        out["only_spark"] = sorted(s_set - d_set)[:3]
        out["only_oracle"] = sorted(d_set - s_set)[:3]
    return out
