from pyspark.sql import functions as F

from cellweave.llm.licenses import ANCHOR, KNOWN, canonical, license_matches


def test_every_known_text_matches_itself_and_holds_an_anchor(spark):
    import re

    assert all(re.search(ANCHOR, t) for _, t in KNOWN)
    docs = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(KNOWN)], "doc_id long, text string")
    found = {(r.doc_id, r.license) for r in license_matches(docs).where("unit = -1").collect()}
    assert found == {(k, name) for k, (name, _) in enumerate(KNOWN)}


def test_case_punctuation_copyright_lines_and_spellings(spark):
    mit = KNOWN[0][1]
    loud = "Copyright (c) 2020 Somebody\n(c) others\n\n  " + mit.upper().replace(",", " ;") + "\nAll rights reserved."
    british = KNOWN[10][1].replace("acknowledgment", "acknowledgement")
    rows = [(1, loud), (2, british), (3, "some text\nLICENCED under the  apache Licence: version 2.0!\nmore"), (4, mit + " and more"), (5, None), (6, "license"), (None, "Released under the MIT License"), (7, "")]
    found = sorted(map(tuple, license_matches(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert found == sorted([(1, -1, "MIT"), (2, -1, "Zlib"), (3, 1, "Apache-2.0"), (None, -1, "MIT"), (None, 0, "MIT")], key=str)


def test_odd_rows(odd, none):
    assert license_matches(odd).count() == 0 and license_matches(none).count() == 0


def test_no_python_in_the_plan(odd, capsys):
    license_matches(odd).explain()
    assert "Python" not in capsys.readouterr().out.replace("PythonRDD", "")


def test_canonical_form(spark):
    row = spark.range(1).select(canonical(F.lit("# Copyright me\nA  LICENCE, v. 2.0\n")).alias("c")).first()
    assert row.c == "a license version 2 0"
