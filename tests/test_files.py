"""CSV tables with damaged lines, and splits whose types drift."""

import pytest

from riskrank.sources import merged_schema, read_checked, read_names, read_splits


def write(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def test_damaged_lines(spark, tmp_path):
    text = 'id,v,name\n1,1.5,a\n2,2.5\n3,3.5,c,extra\n4,x,d\n5,,\n\n6,6.5,"q, ""r"""\n7\n,8.5,h\n9,"1,2",i\n"10,1.0,j\n'
    path = write(tmp_path, "t.csv", text)
    read = read_checked(spark, path, "id int, v double, name string", escape='"')
    assert read.rows.columns == ["id", "v", "name"]
    assert sorted(map(str, map(tuple, read.rows.collect()))) == sorted(
        map(str, [(1, 1.5, "a"), (5, None, None), (6, 6.5, 'q, "r"'), (None, 8.5, "h")])
    )
    got = sorted((r.line, r.reason) for r in read.damaged.collect())
    assert got[:-1] == [('"10,1.0,j', "mistyped"), ("2,2.5", "short"), ("3,3.5,c,extra", "long"), ("4,x,d", "mistyped"), ("7", "short")]
    assert got[-1] == ('9,"1,2",i', "mistyped")
    assert {r.reason: r.n for r in read.counts().collect()} == {"short": 2, "long": 1, "mistyped": 3}
    assert all(r.file.endswith("t.csv") for r in read.damaged.collect())
    # Reading one column must not hide that a line has too many.
    assert read.rows.select("id").where("id is not null").count() == 3


def test_splits_with_drifting_types(spark, tmp_path):
    a = write(tmp_path, "a.csv", "id,n,d,k,e\n1,1,2020-01-01,5,\n2,2,2020-01-02,6,\n")
    b = write(tmp_path, "b.csv", "id,n,d,k,e,more\n3000000000,2.5,2020-01-03 10:00:00,x,,true\n4,3,2020-01-04 00:00:00,7,,false\n")
    schema = merged_schema(spark, [a, b])
    assert [(f.name, f.dataType.simpleString()) for f in schema] == [
        ("id", "bigint"), ("n", "double"), ("d", "timestamp"), ("k", "string"), ("e", "string"), ("more", "boolean"),
    ]
    first, second = read_splits(spark, [a, b])
    assert first.rows.schema == second.rows.schema
    assert [(r.id, r.n, r.k, r.more) for r in first.rows.collect()] == [(1, 1.0, "5", None), (2, 2.0, "6", None)]
    assert [(r.id, r.n, r.k, r.more) for r in second.rows.collect()] == [(3_000_000_000, 2.5, "x", True), (4, 3.0, "7", False)]
    assert first.damaged.count() == second.damaged.count() == 0


def test_lists_of_names(spark, tmp_path):
    path = write(tmp_path, "names.txt", "a\n\n b \nc\n")
    assert read_names(spark, path) == ["a", "b", "c"]
    with pytest.raises(ValueError, match="over 2 lines"):
        read_names(spark, path, max_names=2)
