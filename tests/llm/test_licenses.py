import textwrap

from pulselake.llm.licenses import MORE_TEXTS, TEXTS, TITLES, all_texts, known_digests, known_texts, scan
from tests.llm.compare import SF_DIR
from tests.llm.rows import awkward, awkward_docs, no_docs


def found(spark, texts):
    rows = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    return {r.doc_id: r for r in scan(rows).collect()}


def test_entire_texts_in_other_spelling(spark):
    mit = TEXTS["MIT"]
    texts = [
        mit, mit.upper().replace("\n", "  \n "), "Copyright (c) 2021 Some One\nAll rights reserved.\n" + mit, mit.replace("sublicense", "sublicence"),
        "© 2020-2024 Somebody\n\n" + mit + "\n", mit + " and more", mit.replace("free of charge", "for a fee"), "  " + TEXTS["Zlib"].replace("acknowledgment", "Acknowledgement"),
    ]
    rows = found(spark, texts)
    assert [rows[i].whole_license for i in range(8)] == ["MIT", "MIT", "MIT", "MIT", "MIT", None, None, "Zlib"]


def test_notices_on_lines(spark):
    rows = found(spark, [
        "first line\nReleased under the MIT License.\nlast", "This work is licensed under the GNU General Public Licence, version 3.",
        "a\nlicensed under cc by-nc 4.0\nLicensed under the Apache License, Version 2.0!\nMIT License\nMIT License",
        "it is Released under the MIT License.", "",
    ])
    assert (rows[0].licenses, rows[0].n_license_lines, rows[0].whole_license, rows[0].n_lines) == ("MIT", 1, None, 3)
    assert [tuple(m) for m in rows[0].matches] == [(1, "MIT")]
    assert (rows[1].licenses, rows[1].whole_license, rows[1].n_license_lines) == ("GPL-3.0", "GPL-3.0", 0)
    assert (rows[2].licenses, rows[2].n_license_lines) == ("Apache-2.0,CC-BY-NC-4.0,MIT", 4)
    assert (rows[3].licenses, rows[3].n_license_lines, rows[3].matches) == ("", 0, [])
    assert (rows[4].n_lines, rows[4].licenses) == (0, "")


def test_awkward_rows(spark):
    rows = scan(awkward_docs(spark)).collect()
    expected = sorted(((d, len(t.split("\n")) if t else 0, "") for d, t, *_ in awkward()), key=str)
    assert sorted(((r.doc_id, r.n_lines, r.licenses) for r in rows), key=str) == expected
    assert scan(no_docs(spark)).count() == 0


def test_repeated_rows_and_rows_without_an_id(spark):
    rows = spark.createDataFrame([(None, "MIT License"), (None, "MIT License"), (1, "x\nISC"), (1, "x\nISC"), (1, "y")], "doc_id long, text string")
    assert sorted((str(r.doc_id), r.licenses, r.n_license_lines) for r in scan(rows).collect()) == [
        ("1", "", 0), ("1", "ISC", 1), ("1", "ISC", 1), ("None", "MIT", 0), ("None", "MIT", 0),
    ]


def test_own_table_of_texts(spark):
    rows = spark.createDataFrame([(1, "House Rules!")], "doc_id long, text string")
    assert scan(rows, texts=[("house", "house rules")]).first().whole_license == "house"


def test_known_digests_are_distinct_and_few(spark):
    assert known_digests(spark).count() > 150
    assert len(known_texts()) < 2000


def test_main_path_is_native(spark):
    plan = scan(spark.read.parquet(f"{SF_DIR}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "BroadcastHashJoin" in plan


def test_texts_in_any_wrap(spark):
    cases = [(name, f"Copyright (c) 2021, Some One\n(c) 2019 Another\nCopyright The Authors\n\n{body}")
             for name, text in (*TEXTS.items(), *MORE_TEXTS) for body in (*(textwrap.fill(text, w, break_long_words=False) for w in range(40, 131, 6)), " ".join(text.split()))]
    rows = found(spark, [text for _, text in cases])
    assert [rows[i].whole_license for i in range(len(cases))] == [name for name, _ in cases]


def test_texts_below_their_title_and_zlib_notices(spark):
    cases = [(name, f"{title}\n\nCopyright (c) 2021, Some One. All rights reserved.\n\n{text}") for name, text in (*TEXTS.items(), *MORE_TEXTS) for title in TITLES.get(name, ())]
    cases += [("Zlib", "Released under the zlib License"), ("Zlib", "SPDX-License-Identifier: Zlib")]
    assert {name for name, _ in cases} == {"MIT", "ISC", "Zlib", "BSD-2-Clause", "BSD-3-Clause", "Unlicense"}
    rows = found(spark, [text for _, text in cases])
    assert [rows[i].whole_license for i in range(len(cases))] == [name for name, _ in cases]
    assert len(all_texts()) < 2000


def test_sql_knows_the_same_texts(spark):
    import duckdb

    from pulselake.llm.licenses import all_texts
    from pulselake.llm.oracles import ORACLES

    head = ["Copyright (c) 2024 Some Owner", "© 2023 Owner, all rights reserved", "All rights reserved.", "Copyright notices stay", "Copyright and more", ""]
    wrapped = lambda t, n: "\n".join(" ".join(t.split()[i : i + n]) for i in range(0, len(t.split()), n))
    rows = []
    for i, (_, text) in enumerate(all_texts()):
        rows += [(2 * i, f"{head[i % 6]}\n{text}"), (2 * i + 1, wrapped(text, 5 + i % 9) + ("\n" + head[i % 5]) * (i % 2))]
    rows += [(10_000, None), (10_001, ""), (10_002, "plain text\nof no licence")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ours = {r.doc_id: tuple(r)[1:5] for r in scan(docs).collect()}
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    connection.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    relation = connection.sql(ORACLES["op10_license_scan"])
    at = {c: i for i, c in enumerate(relation.columns)}
    theirs = {r[at["doc_id"]]: tuple(r[at[c]] for c in ("n_lines", "whole_license", "n_license_lines", "licenses")) for r in relation.fetchall()}
    assert ours == theirs and sum(v[1] is not None for v in ours.values()) > len(rows) // 2
