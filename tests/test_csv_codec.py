"""Every value of every type comes back from CSV."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from frame_checks import formatted_plan

from evenkeel.operators.reconcile import reconcile
from evenkeel.sources.files import load_snapshot, read_csv, save_snapshot, write_csv

VALUES = """
select * from values
  (1, 'plain', timestamp'2024-11-03 05:30:00.123456Z', timestamp_ntz'2024-03-10 02:30:00.000001', date'2024-02-29', 0.1d, float(0.1), X'00FF0A', 12.340BD, true),
  (2, '', timestamp_micros(-62135596800000000L), timestamp_ntz'0001-01-01 00:00:00', date'0001-01-01', double('NaN'), float('-Infinity'), X'', -0.000BD, false),
  (3, '\\\\N', timestamp_micros(253402300799999999L), timestamp_ntz'9999-12-31 23:59:59.999999', date'9999-12-31', 4.9E-324d, float(1.4E-45), X'5C4E', 1.500BD, null),
  (4, null, timestamp_micros(253402300800000000L), timestamp_ntz'+10000-01-01 00:00:00', date_from_unix_date(2932897), -0.0d, float(-0.0), null, null, true),
  (5, '\\\\\\n\\\\n\\r\\\\0\\0"x", y', timestamp_micros(-62135596800000001L), timestamp_ntz'-0001-01-01 00:00:00.5', date_from_unix_date(-719163), 1.7976931348623157E308d, float(3.4028235E38), X'0D0A', 0.001BD, true),
  (6, '  @12 ', timestamp_micros(9223372036854775807L), timestamp_ntz'+294247-01-10 04:00:54.775807', date_from_unix_date(2147483647), 123456789.123456789d, float(16777217), X'40', 99999.999BD, true),
  (7, null, timestamp_micros(-9223372036854775808L), null, date_from_unix_date(-2147483648), null, null, null, null, null)
as t(id, s, ts, ntz, d, x, f, b, n, ok)
"""

#: what tells two values apart, Python's limits aside
EXACT = (
    "id", "s", "hex(s) as sx", "unix_micros(ts) as ts", "string(ntz) as ntz", "unix_date(d) as d", "string(x) as x", "string(f) as f", "hex(b) as b", "string(n) as n", "ok",
)


def exact(df):
    return sorted(tuple(r) for r in df.selectExpr(*EXACT).collect())


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kathmandu"])
def test_values(spark, tmp_path, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df, path = spark.sql(VALUES), str(tmp_path / "t")
        write_csv(df, path)
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        back = read_csv(spark, path)
        assert back.dtypes == df.dtypes and exact(back) == exact(df)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


NESTED = """
select id, array(s, 'a\\nb', null) as a, map(id, ts, id + 1, null) as m, struct(ntz as `when`, b, struct(x as X, f as x2) as inner) as st,
       array(struct(map(date'2024-01-01', array(b, null)) as deep), null) as odd,
       if(id = 3, null, array(array(n))) as nn, array() as none, cast(null as struct<q: int>) as nothing
from ({values})"""

EXACT_NESTED = (
    "id", "transform(a, v -> hex(v)) as a", "transform(map_entries(m), e -> struct(e.key, unix_micros(e.value))) as m",
    "struct(string(st.`when`), hex(st.b), string(st.inner.X), string(st.inner.x2)) as st",
    "transform(odd, o -> transform(map_entries(o.deep), e -> struct(string(e.key), transform(e.value, v -> hex(v))))) as odd",
    "string(nn) as nn", "none", "nothing",
)


def test_nested_values(spark, tmp_path):
    df, path = spark.sql(NESTED.format(values=VALUES)), str(tmp_path / "t")
    write_csv(df, path)
    back = read_csv(spark, path)
    assert back.dtypes == df.dtypes

    def rows(frame):
        return sorted(map(str, frame.selectExpr(*EXACT_NESTED).collect()))

    assert rows(back) == rows(df)


def test_other_types(spark, tmp_path):
    df = spark.sql("""
        select interval '1-2' year to month as ym, interval '-3 04:05:06.000007' day to second as ds, parse_json('{"a":[1,null,"x\\\\ny"]}') as v,
               tinyint(-128) as t, smallint(7) as h, 9223372036854775807L as l, cast('9' as decimal(38,38)) as none, decimal('0.1234567890123456789') as dec
        """.replace("cast('9' as decimal(38,38))", "try_cast('9' as decimal(38,38))"))
    path = str(tmp_path / "t")
    write_csv(df, path)
    back = read_csv(spark, path)
    assert back.dtypes == df.dtypes
    as_strings = [f"string({c}) as {c}" for c in df.columns if c != "v"] + ["to_json(v) as v"]
    assert back.selectExpr(*as_strings).collect() == df.selectExpr(*as_strings).collect()


def test_random_text(spark, tmp_path):
    rng = random.Random(1)
    rows = [(i, "".join(rng.choices("\\nr0N\n\r\0\", @é中\t ", k=rng.randint(0, 12)))) for i in range(3000)]
    df, path = spark.createDataFrame(rows, "id int, s string"), str(tmp_path / "t")
    write_csv(df, path)
    back = read_csv(spark, path)
    assert sorted(tuple(r) for r in back.collect()) == rows
    assert sorted((int(r.id), r.s) for r in read_csv(spark, path, as_text=True).collect()) == rows


def test_names_of_columns(spark, tmp_path):
    df, path = spark.sql("select 1 as `a,b\"c`, 'x' as `d.e``f`, 2 as `line\nbreak`, 3 as `Ä`"), str(tmp_path / "t")
    write_csv(df, path)
    back = read_csv(spark, path)
    assert back.columns == df.columns and back.collect() == df.collect()


def test_equal_tables_are_equal_after_csv(spark, tmp_path):
    df, path = spark.sql(VALUES).drop("b"), str(tmp_path / "t")
    save_snapshot(df, path, "csv")
    result = reconcile(df, load_snapshot(spark, path, "csv"), "id")
    assert result.passed and result.counts["matched_rows"] == 7


def test_snapshots_of_earlier_versions_are_read(spark, tmp_path):
    """Values as the writer prints them, with a schema alone or with the note on line breaks."""
    import json

    from evenkeel.sources.files import CSV_OPTIONS

    df = spark.createDataFrame([(1, "x\ny"), (2, "\\\\N"), (3, None), (4, "")], "id int, s string")
    for name, note in (("a", df.schema.jsonValue()), ("b", {"schema": df.schema.jsonValue(), "multiLine": True})):
        path = str(tmp_path / name)
        df.write.options(**CSV_OPTIONS).csv(path)
        spark.createDataFrame([(json.dumps(note),)], "value string").coalesce(1).write.text(path + "_schema")
        assert sorted(tuple(r) for r in read_csv(spark, path).collect()) == [(1, "x\ny"), (2, "\\N"), (3, None), (4, "")]


def test_a_column_is_read_without_the_others_being_decoded(spark, tmp_path):
    path = str(tmp_path / "t")
    write_csv(spark.sql(VALUES), path)
    plan = formatted_plan(read_csv(spark, path).select("id"))
    assert "ReadSchema: struct<id:string>" in plan


def test_python_values(spark, tmp_path):
    rows = [(dt.datetime(2024, 1, 2, 3, 4, 5, 678901), dt.date(2024, 1, 2), Decimal("1.50"), bytearray(b"\n"))]
    df, path = spark.createDataFrame(rows, "t timestamp_ntz, d date, n decimal(10,2), b binary"), str(tmp_path / "t")
    write_csv(df, path)
    assert [tuple(r) for r in read_csv(spark, path).collect()] == rows
