import duckdb

from strata.llm import licenses as L
from strata.llm.license_texts import KNOWN

D = "/root/testdata/sf0.01"


def test_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{D}/documents.parquet'")
    want = sorted(con.execute(L.ORACLE).fetchall())
    got = sorted(tuple(r) for r in L.query(spark, D).collect())
    assert got == want and len(got) > 5


def test_every_notice_line_of_the_data_is_found(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet").collect()
    want = {r.doc_id for r in docs if any(
        x in ("Released under the MIT License.", "Licensed under CC BY-NC 4.0.",
              "Licensed under the Apache License, Version 2.0.",
              "This work is licensed under the GNU General Public License, version 3.")
        for x in r.text.split("\n"))}
    assert want == {r.doc_id for r in L.query(spark, D).collect()} and want


def test_equivalent_forms_and_odd_rows(spark):
    mit = dict(KNOWN[::-1])["MIT"]
    variant = ("// Copyright (c) 2020 Someone\n// All rights reserved.\n"
               + "\n".join("// " + x.upper().replace("SUBLICENSE", "sub-licence") for x in mit.split("\n"))
               + "\n\n")
    bsd = dict(KNOWN[::-1])["BSD-3-Clause"].replace("copyright holder", "copyright owner").replace(
        "COPYRIGHT HOLDER", "Copyright Owner").replace("OTHERWISE", "otherwize")
    data = [(1, mit), (2, variant), (3, "x " + mit), (4, None), (5, ""), (6, "...\n\n"),
            (7, "text\n  * Released under the MIT Licence!\nmore\nreleased UNDER the mit license"),
            (8, "word " * 50000), (9, "Licensed under CC BY-NC 4.0."), (9, "Licensed under CC BY-NC 4.0."),
            (None, "Licensed under CC BY 4.0."), (10, "Copyright 2020 me"), (11, bsd),
            (12, mit.replace("software", "softwares"))]
    df = spark.createDataFrame([(*d, "z") for d in data], "doc_id long, text string, license_id string").repartition(3)
    got = {(r.doc_id, r.license_id): (r.in_whole, r.n_lines) for r in L.scan(df).collect()}
    assert got == {(1, "MIT"): (True, 0), (2, "MIT"): (True, 0), (7, "MIT"): (False, 2),
                   (9, "CC-BY-NC-4.0"): (True, 2), (None, "CC-BY-4.0"): (True, 1), (11, "BSD-3-Clause"): (True, 0)}
    assert L.scan(df.limit(0)).count() == 0


def test_own_registry(spark):
    df = spark.createDataFrame([(1, "Do what you like.")], "doc_id long, text string")
    own = spark.createDataFrame([("ANY", "do what you LIKE")], "license_id string, text string")
    assert [tuple(r) for r in L.scan(df, own).collect()] == [(1, "ANY", True, 1)]


MIT = dict(KNOWN[::-1])["MIT"]
BODY = next(t for i, t in KNOWN if i == "MIT" and t.startswith("Permission"))
BSD = next(t for i, t in KNOWN if i == "BSD-3-Clause")
APACHE = next(t for i, t in KNOWN if i == "Apache-2.0" and "\n" in t)
ORDINARY = {
    1: "MIT License\n\nCopyright (c) 2020 Someone\n\n" + BODY,
    2: "Copyright (c) 2020 Someone\n" + BODY,
    3: BODY.replace("conditions:\n", "conditions:\n\n\n"),
    4: "Copyright 2019 A. Holder, Inc. All rights reserved.\n\n" + BSD.replace("\n", "\n\n"),
    5: "Copyright (c) 2024 Acme. Licensed under the MIT License.",
    6: ("MIT License Copyright (c) 2020 X. Y. " + BODY).replace("\n", " "),
    7: ("(c) 2020 X, all rights reserved. " + BODY).replace("\n", " "),
    8: "  Copyright 2020 Me\n\n" + "\n".join("   " + w for w in APACHE.split(". ")).replace("\n", ".  \n"),
}


def test_ordinary_licence_files_are_found_by_both_engines(spark, tmp_path):
    path = f"{tmp_path}/documents.parquet"
    df = spark.createDataFrame(list(ORDINARY.items()), "doc_id long, text string")
    df.write.parquet(path)
    got = sorted(tuple(r) for r in L.query(spark, str(tmp_path)).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/*.parquet')")
    assert got == sorted(con.execute(L.ORACLE).fetchall())
    whole = {d: i for d, i, w, _ in got if w}
    assert whole == {1: "MIT", 2: "MIT", 3: "MIT", 4: "BSD-3-Clause", 5: "MIT", 6: "MIT", 7: "MIT", 8: "Apache-2.0"}


def test_every_known_text_is_found_with_other_line_breaks(spark):
    rows = [(k, "Copyright (C) 2001 Holder\n\n" + t.replace(" ", "\n", 3).replace("\n", "\n\n "))
            for k, (_, t) in enumerate(KNOWN) if "\n" in t]
    got = {r.doc_id: r.license_id for r in L.scan(
        spark.createDataFrame(rows, "doc_id long, text string")).filter("in_whole").collect()}
    assert got == {k: KNOWN[k][0] for k, _ in rows}
