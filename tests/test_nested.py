from conftest import rows

import slicewise as sw

RECORDS = [
    '{"id":1,"a":[{"x":1,"y":"p"},{"x":2,"y":"q"}],"s":{"k":{"m":1}}}',
    '{"id":2,"a":[]}',
    '{"id":3}',
]


def records(spark, tmp_path, lines=RECORDS):
    path = tmp_path / "records.json"
    path.write_text("\n".join(lines))
    return sw.read_json(spark, str(path))


def test_flatten_drops_empty_arrays(spark, tmp_path):
    df = records(spark, tmp_path)
    flat = sw.flatten(df)
    assert flat.columns == ["id", "s", "a~x", "a~y", "s~k~m"]
    assert rows(flat, "id", "a~x", "a~y", "s~k~m") == [(1, 1, "p", 1), (1, 2, "q", 1)]
    assert rows(sw.nested_record_count(df)) == [(3,)]


def test_flatten_keeps_empty_arrays_on_request(spark, tmp_path):
    flat = sw.flatten(records(spark, tmp_path), keep_empty=True, keep_structs=False)
    assert flat.columns == ["id", "a~x", "a~y", "s~k~m"]
    assert rows(flat, "id", "a~x") == [(1, 1), (1, 2), (2, None), (3, None)]


def test_several_arrays_multiply_and_plain_values_stay(spark, tmp_path):
    df = records(spark, tmp_path, ['{"id":1,"a":[{"x":1},{"x":2}],"tags":["p","q"]}'])
    flat = sw.flatten(df)
    assert rows(flat, "id", "a~x", "tags") == [(1, 1, "p"), (1, 1, "q"), (1, 2, "p"), (1, 2, "q")]


def test_decimals_inside_structs(spark):
    df = spark.sql("SELECT named_struct('d', CAST(1.5 AS DECIMAL(10,2)), 'n', named_struct('e', 2)) AS s")
    flat = sw.flatten(df, keep_structs=False)
    assert flat.dtypes == [("s~d", "decimal(10,2)"), ("s~n~e", "int")]


def test_given_schema(spark, tmp_path):
    path = tmp_path / "r.json"
    path.write_text('{"id":1,"x":"y"}\n')
    assert sw.read_json(spark, str(path), "id int").dtypes == [("id", "int")]


def test_json_field_profile(spark):
    data = [('{"a":1,"b":2}',), ('{"a":null}',), (None,), ("not json",), ("{}",)]
    df = spark.createDataFrame(data, "j string")
    assert rows(sw.json_field_profile(df, "j"), "key", "n", "n_rows") == [("a", 2, 5), ("b", 1, 5)]
