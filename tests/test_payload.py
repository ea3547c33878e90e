import datetime

from pyspark.sql import functions as F

from rivulet import model
from rivulet.functions.temporal import decode_temporals
from rivulet.operators import payload, registry
from rivulet.session import scratch
from rivulet.sources.buckets import BucketStore
from tests.helpers import rows

NEW_YEAR = datetime.datetime(2024, 1, 1)


def test_every_unit_gives_the_same_instant(spark):
    texts = ["1704067200", "1704067200000", "1704067200000000", "1704067200000000000", "2024-01-01T00:00:00Z",
             "2024-01-01T02:00:00+02:00", "2024-01-01 00:00:00", "junk", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r.v for r in decode_temporals(df, {"v": "timestamp_ntz"}).collect()]
    assert got == [NEW_YEAR] * 7 + [None] * 3


def test_dates_and_named_units(spark):
    df = spark.createDataFrame([("19723", "5"), ("2024-01-01", "-5"), ("x", "99999999999999999999999")], "d string, t string")
    got = rows(decode_temporals(df, {"d": "date", "t": "timestamp_ntz"}, {"t": "ms"}))
    epoch = datetime.datetime(1970, 1, 1)
    assert got == sorted(
        [
            (NEW_YEAR.date(), epoch + datetime.timedelta(milliseconds=5)),
            (NEW_YEAR.date(), epoch - datetime.timedelta(milliseconds=5)),
            (None, None),
        ],
        key=repr,
    )


def test_payload_spelling_and_presence(spark):
    stage = spark.createDataFrame(
        [(1, "u", "1", 1, '{"ID":7,"Name":"a"}'), (1, "u", "2", 2, '{"id":8,"name":null}'), (1, "u", "3", 3, "broken")],
        "tenant_id int, op string, commit_lsn string, stage_seq bigint, value_json string",
    )
    shape = model.shape("tenant_id int, id int, name string, at timestamp, batch_id bigint")
    got = payload.parse_payload(stage, shape, ["ID", "id", "Name", "name"], carried=True)
    assert rows(got, "stage_seq", "id", "name", "_carried") == [
        (1, 7, "a", ["id", "name"]), (2, 8, None, ["id", "name"]), (3, None, None, None),
    ]


def test_envelope_defaults_and_heartbeats(spark):
    at = datetime.datetime(2024, 1, 1)
    raw = ['{"__source_table":"t","__source_ts_ms":1704067200123,"__op":"d","__source_schema":"s"}',
           '{"__table":"t2","__commit_lsn":"L"}', '{"heartbeat":1}', "not json"]
    df = spark.createDataFrame([(bytearray(r.encode()), at) for r in raw], "value binary, timestamp timestamp")
    got = payload.stage_envelope(df, tenant_id=3, default_schema="dflt", batch_id=1, micro_batch_id=2, run_id="r")
    assert rows(got, "source_schema", "source_table", "op", "commit_lsn") == [
        ("dflt", "t2", "u", "L"), ("s", "t", "d", None),
    ]
    first = got.filter("source_table = 't'").select(F.unix_millis("source_commit_ts")).first()[0]
    assert first == 1704067200123


def test_writable_columns():
    write, skipped = payload.writable_columns(
        ["tenant_id", "Id", "Name", "ModifiedOn", "op", "_op"], ["tenant_id", "Id", "Name", "ModifiedOn", "_op"], ["id"]
    )
    assert write == ["tenant_id", "Id", "ModifiedOn", "_op"] and skipped == ["Name"]
    assert payload.writable_columns(["ModifiedOn"], ["ModifiedOn"], [], filled=False) == ([], ["ModifiedOn"])
    assert payload.missing_keys(["Id", "x"], ["id"]) == ["x"]


def test_registry_keys_are_trimmed(spark):
    df = spark.createDataFrame(
        [("S", "t", "b", " a , b,", True), ("S", "u", "b", None, True), ("S", "v", "b", "a", False)], model.REGISTRY
    )
    assert rows(registry.active_registry(df, "s"), "source_table", "pk") == [("t", ["a", "b"])]


def test_explicit_tables_switch_scope_off(spark):
    reg = spark.createDataFrame([("S", "t", "b", "a", True), ("S", "u", "b", "a", True)], model.REGISTRY)
    cols = spark.createDataFrame([("S", "t", "ModifiedOn")], "table_schema string, table_name string, column_name string")
    assert rows(registry.classify_roads(reg, cols, ["S"], tables=" T "), "source_table", "road") == [("t", "explicit")]


def test_align_adds_and_renames(spark):
    df = spark.createDataFrame([("7",)], "ID string")
    assert rows(model.align_schema(df, model.shape("Id int, at timestamp"))) == [(7, None)]


DDL = """
-- two tables, and one whose text was cut
CREATE TABLE IF NOT EXISTS bronze.Person (
  tenant_id INT NOT NULL, `Id` STRING COMMENT 'the (only) key', Rate DECIMAL(12,4), At TIMESTAMP, Gone BOOLEAN,
  _ingest_date DATE, _op STRING, batch_id BIGINT
) USING delta CLUSTER BY (tenant_id, Id) TBLPROPERTIES ('a' = 'b');
create or replace table `x`.`Y` (a array<struct<b: int>>) ;
CREATE TABLE cut (a INT, b DECI
"""


def test_shapes_come_from_ddl_in_its_order(spark):
    shapes = model.shapes_from_ddl(DDL)
    assert list(shapes) == ["person", "y"]
    assert shapes["person"].simpleString() == (
        "struct<tenant_id:int,Id:string,Rate:decimal(12,4),At:timestamp,Gone:boolean,_ingest_date:date,_op:string,batch_id:bigint>"
    )


def test_tables_are_made_from_ddl(spark):
    made = BucketStore(spark, scratch(spark, "ddl"), model.shapes_from_ddl(DDL), {"person": ["Id"]}, 2)
    made.load("person", model.align_schema(spark.createDataFrame([(1, "a", 7)], "tenant_id int, id string, batch_id int"), made.schema("person")))
    assert rows(made.read("person"), "tenant_id", "Id", "Rate", "batch_id") == [(1, "a", None, 7)]
