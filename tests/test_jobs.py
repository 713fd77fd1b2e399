import pytest

from tallywright.__main__ import parser, run


def start(spark, *arguments):
    run(spark, parser().parse_args([str(a) for a in arguments]))


@pytest.fixture
def source(tmp_path):
    def write(text, name="input.txt"):
        path = tmp_path / name
        path.write_text(text)
        return path

    return write


def test_lines(spark, source, tmp_path):
    start(spark, "lines", source("a\nb\nc\n"), tmp_path / "out")
    assert [r.value for r in spark.read.text(str(tmp_path / "out")).collect()] == ["line\t3"]


def test_kmeans_and_seeds(spark, source, tmp_path, capsys):
    points = source("0,0\n0,2\n10,10\n10,12\nbad\n", "points.txt")
    seeds = source("0,0\n10,10\n99,99\n", "seeds.txt")
    start(spark, "kmeans", points, tmp_path / "out", seeds, 2, "--iterations", 3)
    for i in range(3):
        rows = [r.value for r in spark.read.text(str(tmp_path / f"out_{i}")).collect()]
        assert rows == ["0\t0.0,1.0", "1\t10.0,11.0"]
    assert capsys.readouterr().out.count(" ms") == 3
    start(spark, "seeds", points, tmp_path / "drawn", 2)
    drawn = [r.value for r in spark.read.text(str(tmp_path / "drawn")).collect()]
    assert len(set(drawn)) == 2


def test_parity_and_salaries(spark, source, tmp_path):
    start(spark, "parity", source("1\n2\n-3\n"), tmp_path / "p")
    assert {tuple(r) for r in spark.read.parquet(f"{tmp_path}/p/parity").collect()} == {("Odd", 2), ("Even", 1)}
    start(spark, "salaries", source("a 1\nb 2\na 3\n"), tmp_path / "s")
    rows = spark.read.parquet(f"{tmp_path}/s/salaries").collect()
    assert {tuple(r) for r in rows} == {("a", 4.0), ("b", 2.0)}


def test_words(spark, source, tmp_path):
    start(spark, "words", source("When Lord, Lord\nx x x\n"), tmp_path / "w", "--top", 2)
    read = lambda name: [tuple(r) for r in spark.read.parquet(f"{tmp_path}/w/{name}").collect()]
    assert set(read("selected")) == {("When", 1), ("Lord", 1)}
    assert read("top") == [("x", 3), ("Lord", 1)]
    assert read("bottom") == [("Lord", 1), ("Lord,", 1)]


def test_connections(spark, source, tmp_path):
    line = "{},tcp,http,SF,{},{},{}\n"
    text = "".join(line.format(i % 3, i, 2 * i, "normal." if i % 2 else "smurf.") for i in range(60))
    start(spark, "connections", source(text), tmp_path / "c", "--label", 6, "--partitions", 2)
    assert spark.read.parquet(f"{tmp_path}/c/protocols").first()["count"] == 60
    assert spark.read.parquet(f"{tmp_path}/c/fields").first().fields == 7
    assert 0 <= spark.read.parquet(f"{tmp_path}/c/accuracy").first().accuracy <= 1


def test_comments(spark, source, tmp_path):
    rows = "".join(f'"buy, {"now " * (i + 1)}",1,,\n"thanks {"song " * (i + 1)}",0,2020,\n' for i in range(15))
    start(spark, "comments", source("CONTENT,CLASS,DATE,Column6\n" + rows), tmp_path / "m", "--trees", 3)
    assert spark.read.parquet(f"{tmp_path}/m/profile/columns").count() == 4
    assert spark.read.parquet(f"{tmp_path}/m/models/comparison").count() >= 4
