"""Runs a registered query and its SQL on the same tables and compares the rows."""

import datetime
import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, (datetime.date, datetime.datetime)):
        return str(value)
    return value


def ordered(rows, columns):
    index = [columns.index(c) for c in sorted(columns)]
    return sorted([tuple(plain(row[i]) for i in index) for row in rows], key=repr)


def differences(spark, connection, sf_dir, function, sql):
    """(number of rows, list of complaints)"""
    frame = function(spark, sf_dir)
    got = [tuple(r) for r in frame.collect()]
    relation = connection.execute(sql)
    wanted_columns = [d[0] for d in relation.description]
    wanted = relation.fetchall()
    if sorted(frame.columns) != sorted(wanted_columns):
        return len(got), [f"columns {sorted(frame.columns)} != {sorted(wanted_columns)}"]
    a, b = ordered(got, frame.columns), ordered(wanted, wanted_columns)
    complaints = [] if len(a) == len(b) else [f"{len(a)} rows, expected {len(b)}"]
    only_a, only_b = sorted(set(a) - set(b), key=repr), sorted(set(b) - set(a), key=repr)
    complaints += [f"only in spark: {r}" for r in only_a[:3]] + [f"only in sql: {r}" for r in only_b[:3]]
    if not complaints and a != b:
        complaints = ["multiplicities differ"]
    return len(a), complaints
