import os

import pytest
from pyspark.sql import functions as F

from checks.compare import _rows, duck
from voicetide.llm import line_templates as lt
from voicetide.llm import queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def own(i):
    return f"document{'abcdefghijklmnopqrstuvwxyz'[i % 26] * (3 + i // 26)} tells quite another storyline altogether today"


def run(spark, texts):
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)
    return {r.doc_id: r for r in lt.dedup(docs).orderBy("doc_id").collect()}


def test_recurring_lines_go_and_the_rest_stays(spark):
    footer = "All rights are reserved by the publisher"
    found = run(spark, [f"{own(i)}\n{footer}\n\nlast words" for i in range(3)] + [f"{own(3)}\nonce only here"])
    assert [found[i].text for i in range(3)] == [f"{own(i)}\n\nlast words" for i in range(3)]
    assert found[3].text == f"{own(3)}\nonce only here"
    assert [(found[i].n_lines, found[i].n_dropped) for i in (0, 3)] == [(3, 1), (2, 0)]


def test_two_texts_are_not_enough(spark):
    found = run(spark, [f"{own(i)}\nthis line recurs but twice" for i in range(2)])
    assert all(r.n_dropped == 0 for r in found.values())


def test_numbers_are_variable_fields(spark):
    found = run(spark, [f"{own(i)}\nPage {i} of 2{i} printed" for i in range(4)])
    assert [r.text for r in found.values()] == [own(i) for i in range(4)]


def test_other_fields_become_variable(spark):
    names = ["anna", "boris", "clara", "dmitri"]
    line = "User logged in successfully named {} from the {} office"
    found = run(spark, [f"{own(i)}\n{line.format(n, n[::-1])}" for i, n in enumerate(names)])
    assert [r.text for r in found.values()] == [own(i) for i in range(4)]
    # below the similarity the lines stay
    found = run(spark, [f"{own(i)}\nUser logged in {n} {n[1:]} {n[2:]} {n[::-1]}" for i, n in enumerate(names)])
    assert all(r.n_dropped == 0 for r in found.values())


def test_copied_documents_are_left_alone(spark):
    whole = "\n".join(f"the copied document has a remarkable line about subject{c}" for c in "abcde")
    found = run(spark, [whole] * 6 + [whole + f"\ntail {'xyzuvw'[i]}" for i in range(6)] + [own(i) for i in range(4)])
    assert all(r.n_dropped == 0 for r in found.values())


def test_a_long_passage(spark):
    passage = " ".join(f"passage word{'abcdefghij'[k % 10]}" for k in range(40))
    found = run(spark, [f"{own(i)}\n{passage}" for i in range(5)])
    assert [r.text for r in found.values()] == [own(i) for i in range(5)]


def test_cases(spark, edge, nothing):
    plenty = edge
    for i in range(3):
        line = f"{own(i)}\na line that recurs everywhere"
        plenty = plenty.union(
            edge.limit(1).withColumn("doc_id", F.lit(100 + i).cast("long")).withColumn("text", F.lit(line))
        )
    found = lt.dedup(plenty)
    assert [c for c in found.columns if c not in ("n_lines", "n_dropped")] == [
        c for c in plenty.columns if c not in ("n_lines", "n_dropped")
    ]
    rows = found.collect()
    assert len(rows) == plenty.count()
    assert sorted(r.text for r in rows if r.doc_id and r.doc_id >= 100) == sorted(own(i) for i in range(3))
    assert sum(r.text is None for r in rows) == 2
    before = sorted(repr(r.text) for r in edge.collect())
    assert sorted(repr(r.text) for r in rows if not (r.doc_id and r.doc_id >= 100)) == before
    assert lt.dedup(nothing).count() == 0


def test_a_text_that_loses_all_lines_is_empty(spark):
    found = run(spark, ["only this one line here"] + [f"{own(i)}\nonly this one line here" for i in range(3)])
    assert found[0].text == "" and found[0].n_dropped == 1


def test_the_main_path_has_no_python(documents):
    plan = lt.dedup(documents)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


@pytest.mark.parametrize("extra", [["a\tb\tc\nx y\x0bz q", "a b c", "d\na  b\tc"], [None, "", "\n\n"]])
def test_sql_on_odd_texts(spark, tmp_path, extra):
    texts = extra + [f"{own(i)}\nv{i} User {n} was here and went away" for i, n in enumerate(["ann", "bob", "cy", "di"])]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], SCHEMA)
    docs.coalesce(1).write.parquet(str(tmp_path / "d"))
    con = duck("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    cursor = con.execute(queries.OP7_SQL)
    want = _rows([d[0] for d in cursor.description], cursor.fetchall())
    found = lt.dedup(docs).select("doc_id", "n_lines", "n_dropped", "text")
    assert _rows(found.columns, [tuple(r) for r in found.collect()]) == want


@pytest.mark.parametrize("shared, mine", [(3, 1), (5, 1), (10, 1), (10, 3), (20, 3)])
def test_lines_of_a_passage_do_not_protect_each_other(spark, shared, mine):
    passage = [f"shared{'abcdefghijklmnopqrstuvwxyz'[k]} line of the passage that every text holds" for k in range(shared)]
    private = ["\n".join(own(26 * k + i) for k in range(mine)) for i in range(6)]
    found = run(spark, ["\n".join([*passage, p]) for p in private])
    assert [found[i].text for i in range(len(found))] == private


def test_texts_of_templates_alone(spark):
    page = "Reading {} was taken at noon\nStation number {} reports no fault\nSerial {} of the series"
    found = run(spark, [page.format(i, 7 * i, 100 + i) for i in range(5)])
    assert [(r.text, r.n_dropped) for r in found.values()] == [("", 3)] * 5


def copies(stem, n):
    """Edited copies of a text of twelve lines: one word of another line in each."""
    alphabet = "abcdefghijkl"
    body = [
        [f"{stem}{alphabet[k]}{alphabet[w]}" for w in range(12)] for k in range(12)
    ]
    out = []
    for i in range(n):
        made = [list(x) for x in body]
        made[i % 12][(5 * i) % 12] = f"edit{stem}{alphabet[i % 12]}{alphabet[i // 12]}"
        out.append("\n".join(" ".join(x) for x in made))
    return out


def test_edited_copies_are_left_alone(spark):
    found = run(spark, copies("tree", 40) + [own(i) for i in range(4)])
    assert all(r.n_dropped == 0 for r in found.values())


def test_a_line_in_groups_of_copies(spark):
    licence = "Published under the public licence of the library"
    bodies = [c for stem in ("tree", "lake", "hill", "moon") for c in copies(stem, 4)]
    found = run(spark, [f"{b}\n{licence}" for b in bodies])
    assert [found[i].text for i in range(len(found))] == bodies


def test_a_group_of_copies_has_no_veto(spark):
    licence = "Published under the public licence of the library"
    group = copies("tree", 40)
    found = run(spark, [f"{b}\n{licence}" for b in group] + [f"{own(i)}\n{licence}" for i in range(6)])
    assert [found[i].text for i in range(len(found))] == group + [own(i) for i in range(6)]


def test_short_lines_that_recur_often_go(spark):
    found = run(spark, [f"Home\n{own(i)}\nRead more" for i in range(12)] + [f"{own(20 + i)}\nThe." for i in range(3)])
    assert [found[i].text for i in range(len(found))] == [own(i) for i in range(12)] + [f"{own(20 + i)}\nThe." for i in range(3)]


def test_copies_keep_their_short_lines(spark):
    group = [f"Home\n{c}" for c in copies("tree", 40)]
    assert all(r.n_dropped == 0 for r in run(spark, group).values())


def test_frequent_values_of_a_field(spark):
    names = ["anna"] * 5 + ["boris"] * 4 + ["clara", "dmitri"]
    found = run(spark, [f"{own(i)}\nPosted by the author {n} in our main forum" for i, n in enumerate(names)])
    assert [found[i].text for i in range(len(found))] == [own(i) for i in range(len(names))]


def test_a_line_of_copies_goes_by_its_template(spark):
    line = "Posted by the author {} in our main forum"
    group = [f"{c}\n{line.format('anna')}" for c in copies("tree", 12)]
    found = run(spark, group + [f"{own(i)}\n{line.format(n)}" for i, n in enumerate(["boris", "clara", "dmitri"])])
    assert all(r.n_dropped == 1 for r in found.values())


def test_lines_are_deleted_once_their_places_are_written(spark, monkeypatch):
    names = {}
    real = lt.written

    def seen(rows, name):
        names[name] = real(rows, name)
        return names[name]

    monkeypatch.setattr(lt, "written", seen)
    docs = spark.createDataFrame([(i, f"line one of {i}\nthe same words again here") for i in range(8)], "doc_id long, text string")
    places = lt.places_of(docs)
    assert places.count() == 16
    folder = names["lines"].inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert not os.path.exists(folder)
