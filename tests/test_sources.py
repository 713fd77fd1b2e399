import pytest
from pyspark.errors import AnalysisException

from tallywright.session import materialize, shared_dir
from tallywright.sources import (
    centroid_rows,
    infer_csv_schema,
    read_centroids,
    read_checked_csv,
    read_lines,
    read_points,
    read_positional,
    read_seeds,
    read_table_csv,
    spread,
    write_kv,
)


def test_lines_plain_and_gzip(spark, strings, tmp_path):
    df = strings("one", "", "three")
    df.coalesce(1).write.text(str(tmp_path / "plain"))
    df.write.text(str(tmp_path / "packed"), compression="gzip")
    assert [r.value for r in read_lines(spark, str(tmp_path / "plain")).collect()] == ["one", "", "three"]
    packed = read_lines(spark, str(tmp_path / "packed"), partitions=5)
    assert packed.rdd.getNumPartitions() == 5
    assert sorted(r.value for r in packed.collect()) == ["", "one", "three"]


def test_csv_schema_inference_and_quotes(spark, tmp_path):
    path = tmp_path / "ratings.csv"
    path.write_text("userId,movieId,rating\n1,2,3.5\n4,5,bad\n")
    typed = read_table_csv(spark, str(path), "userId int, movieId int, rating double")
    assert [tuple(r) for r in typed.collect()] == [(1, 2, 3.5), (4, 5, None)]
    assert dict(read_table_csv(spark, str(path)).dtypes)["userId"] == "int"
    path = tmp_path / "comments.csv"
    path.write_text('CONTENT,CLASS\n"two\nlines, ""quoted""",1\nplain,\n')
    rows = read_table_csv(spark, str(path), "CONTENT string, CLASS double", multi_line=True)
    assert [tuple(r) for r in rows.collect()] == [('two\nlines, "quoted"', 1.0), ("plain", None)]


def test_positional_short_lines_give_null(strings):
    rows = read_positional(strings("a,b,c", "a", ",,z,"), {"first": 0, "third": 2}).collect()
    assert [tuple(r) for r in rows] == [("a", "c"), ("a", None), ("", "z")]


def test_positional_separator_is_literal(strings):
    assert read_positional(strings("a|b.c"), {"x": 1}, sep="|").first().x == "b.c"
    assert read_positional(strings("a|b.c"), {"x": 1}, sep=".").first().x == "c"


def test_points_of_any_width(strings):
    rows = read_points(strings("1,2.5", "1,2,3,", "-1e3", "1,x", "", "NaN,1")).collect()
    assert [r.x for r in rows[:5]] == [[1.0, 2.5], [1.0, 2.0, 3.0], [-1000.0], [1.0, None], [None]]


def test_seeds_are_the_first_lines_in_order(spark, tmp_path):
    path = tmp_path / "seeds.txt"
    path.write_text("5,5\n1,1\n3,3\n2,2\n")
    rows = read_seeds(spark, str(path), 3).orderBy("cid").collect()
    assert [(r.cid, r.c) for r in rows] == [(0, [5.0, 5.0]), (1, [1.0, 1.0]), (2, [3.0, 3.0])]
    path.write_text("5,five\n")
    with pytest.raises(ValueError):
        read_seeds(spark, str(path), 1)


def test_centroids_round_trip_keeps_ids(spark, tmp_path):
    rows = [(0, [34.59287109222788, 2.2194050190820787]), (3, [50.51518721829889, 1e-9])]
    path = str(tmp_path / "centroids")
    write_kv(spark.createDataFrame(rows, "cid int, c array<double>").coalesce(1), path)
    text = [r.value for r in spark.read.text(path).collect()]
    assert text[0] == "0\t34.59287109222788,2.2194050190820787"
    assert centroid_rows(read_centroids(spark, path)) == rows
    with pytest.raises(AnalysisException):
        write_kv(spark.createDataFrame(rows, "cid int, c array<double>"), path)


def test_key_value_text_is_not_quoted(spark, tmp_path):
    path = str(tmp_path / "kv")
    rows = [('say "hi"', 1), ("back\\slash", 2), (None, 3)]
    write_kv(spark.createDataFrame(rows, "word string, n bigint"), path)
    text = sorted(r.value for r in spark.read.text(path).collect())
    assert text == ["3", "back\\slash\t2", 'say "hi"\t1']


def test_repeated_centroid_ids_are_refused(spark):
    rows = [(0, [1.0]), (0, [2.0])]
    with pytest.raises(ValueError):
        centroid_rows(spark.createDataFrame(rows, "cid int, c array<double>"))


def test_spread_leaves_split_input_alone(spark):
    narrow = spark.range(10).coalesce(1)
    assert spread(narrow, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    wide = spark.range(100).repartition(20)
    assert spread(wide, "id") is wide


def test_shared_folder_follows_the_session(spark):
    class Session:
        def __init__(self, master, **conf):
            self.conf = conf
            self.sparkContext = type("Context", (), {"master": master, "applicationId": "a1"})

    assert shared_dir(Session("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})) == "hdfs:///shared"
    with pytest.raises(RuntimeError):
        shared_dir(Session("yarn"))
    assert shared_dir(Session("local[2]")) == shared_dir(Session("local[2]"))


def test_materialized_tables_keep_schema_and_rows(spark):
    df = spark.range(5).selectExpr("id", "cast(null as string) as s", "array(1.5D) as x")
    stored = materialize(df, "test")
    assert stored.orderBy("id").collect() == df.orderBy("id").collect()
    assert stored.dtypes == df.dtypes


def test_malformed_lines_are_set_apart(spark, tmp_path):
    lines = ["id,name,score", "1,a,2.5", '2,"b, ""x""",3', "x,c,1", "3,d", "4,e,1,more", "5,,", "", "6,f,n/a", "id,name,score"]
    (tmp_path / "a.csv").write_text("\n".join(lines))
    (tmp_path / "b.csv").write_text("id,name,score\n7,g,0\n")
    good, bad = read_checked_csv(spark, str(tmp_path), "id int, name string, score double")
    rows = sorted(tuple(r) for r in good.collect())
    assert rows == [(1, "a", 2.5), (2, 'b, "x"', 3.0), (5, None, None), (7, "g", 0.0)]
    assert good.dtypes == [("id", "int"), ("name", "string"), ("score", "double")]
    assert sorted(r.value for r in bad.collect()) == ["3,d", "4,e,1,more", "6,f,n/a", "x,c,1"]
    assert good.count() == 4 and bad.count() == 4


def test_schema_from_the_first_lines(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("n,x,s\n" + "".join(f"{k},{k / 2},t{k}\n" for k in range(50)) + "oops,1,t\n")
    good, bad = read_checked_csv(spark, str(path), sample_lines=20)
    assert good.dtypes == [("n", "int"), ("x", "double"), ("s", "string")]
    assert good.count() == 50 and [r.value for r in bad.collect()] == ["oops,1,t"]
    assert infer_csv_schema(spark, str(path)).names == ["n", "x", "s"]
    assert infer_csv_schema(spark, str(path))["n"].dataType.simpleString() == "string"
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(ValueError):
        infer_csv_schema(spark, str(tmp_path / "empty.csv"))
