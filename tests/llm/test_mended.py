"""Cases that earlier versions got wrong."""

import pytest

from lexmill.llm import license_scan, shingle_join, topk_search

LICENSES = [
    ("This software is released under the MIT License.\nAll rights reserved.", "MIT"),
    ("SPDX-License-Identifier: MIT OR Apache-2.0", "Apache-2.0,MIT"),
    ("// SPDX-License-Identifier: (MIT OR GPL-2.0-only)\nint x;", "MIT,GPL-2.0-only"),
    ("SPDX-License-Identifier: GPL-3.0+", "GPL-3.0-or-later"),
    ("/* SPDX-License-Identifier: GPL-2.0 WITH Linux-syscall-note */", "GPL-2.0-only"),
    ("SPDX-License-Identifier: Apache-2.0 AND (MIT OR ISC)", "Apache-2.0,MIT,ISC"),
    ("SPDX-License-Identifier: NOASSERTION", ""),
    ("Distributed under the terms of the MIT license.", "MIT"),
    ("Mozilla Public License Version 2.0\n==================================\n\n1. Definitions\n", "MPL-2.0"),
    ("Licensed under either of Apache License, Version 2.0 or MIT license at your option.", "Apache-2.0,MIT"),
    ("                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Copyright (C) 2007\n\n                            Preamble\n\n  The GNU General Public License is a free, copyleft license for\nsoftware and other kinds of works.\n", "GPL-3.0-only"),
    ("GNU GENERAL PUBLIC LICENSE\n   Version 2, June 1991\n", "GPL-2.0-only"),
    ("GNU LESSER GENERAL PUBLIC LICENSE\n   Version 2.1, February 1999\n", "LGPL-2.1-only"),
    ("It is not licensed under the MIT License.", ""),
    ("All rights reserved.", "Proprietary"),
    ("Released under the Foo licence. All rights reserved.", ""),
    ("Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice,\n   this list of conditions and the following disclaimer.\n"
     "2. Redistributions in binary form must reproduce the above copyright notice,\n   this list of conditions and the following disclaimer in the documentation\n   and/or other materials provided with the distribution.\n\nAll rights reserved.\n", "BSD-2-Clause"),
    (None, ""), ("", ""), ("word " * 200_000 + "\n\nReleased under the MIT License.", "MIT"),
]


def test_licences_named_in_many_ways(spark):
    rows = [(None if i % 5 == 4 else i // 2, t, 1, "x") for i, (t, _) in enumerate(LICENSES)]
    got = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string, ids int, seq string").coalesce(1)).collect()
    assert [r.licenses for r in got] == [want for _, want in LICENSES]


def test_the_sql_of_the_scan_says_the_same(spark):
    import duckdb
    import pandas as pd

    texts = [t for t, _ in LICENSES if t is not None and "\n\n" not in t and len(t) < 1000 and not t.startswith("GNU")]
    texts += [f"{a} {b}" for a in ("We say it is", "Not", "") for b in ("licensed under the MIT License", "distributed under the terms of the Apache License, Version 2.0.")]
    documents = pd.DataFrame({"doc_id": range(len(texts)), "text": texts})
    con = duckdb.connect()
    con.register("documents", documents)
    want = con.sql(f"select doc_id, n_sentences, licenses, rest from ({license_scan.oracle_sql()}) order by doc_id").fetchall()
    got = license_scan.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == want


def test_every_twin_is_a_candidate(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in (20, 20, 21, 21, 22)], "vec_id long, embedding array<float>")
    got = topk_search.exact_topk(df, df.filter("vec_id = 20"), 20).collect()
    assert sorted((r.rank, r.vec_id) for r in got) == sorted([(1, 20), (2, 21), (3, 21), (4, 22)] * 2)


def test_the_driver_gets_a_bounded_sample(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "SEEDS", 64)
    df = spark.range(6000).selectExpr("id as vec_id", "array(cast(id % 97 as double), cast(id % 89 as double)) as embedding").repartition(200)
    got = []
    collect = type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: got.append(collect(self)) or got[-1])
    topk_search.exact_topk(df, df.filter("vec_id % 500 = 0"), 3)
    assert 0 < max(map(len, got)) <= 128


@pytest.mark.parametrize("ids", [(2**63 - 1, 5, 5), (-(2**63), 2**63 - 1, 7, 7), (None, 2**63 - 1, 3, None)])
def test_ids_at_the_ends_of_the_range(spark, ids):
    text = "one two three four five six seven eight nine ten"
    df = spark.createDataFrame([(i, text) for i in ids], "doc_id long, text string")
    got = shingle_join.ngram_jaccard_join(df, 4, 85).collect()
    least = min(i for i in ids if i is not None)
    assert len(got) == len(ids) and {r.component_id for r in got if r.doc_id is not None} == {least}
    assert shingle_join.one_of_each(df).count() == 1


def test_a_cut_draws_the_same_sample(spark, monkeypatch):
    from pyspark.sql import functions as F

    from lexmill.llm import language_id

    monkeypatch.setattr(language_id, "SAMPLE", 20)
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "aa").when(F.col("id") % 500 == 1, "bb").otherwise("cc").alias("lang"), F.xxhash64((F.col("id") % 2500).cast("string")).alias("key"), F.xxhash64("id").alias("mark"), (F.col("id") % 7 == 0).alias("long"))
    rows = df.collect()
    want = []
    for lang in ("aa", "bb", "cc"):
        want += [(lang, r.key, r.mark) for r in sorted((r for r in rows if r.lang == lang), key=lambda r: (r.long, r.key, r.mark))[:20]]
    assert sorted((r.lang, r.key, r.mark) for r in language_id._first_of_each(df)) == sorted(want)
    one = df.withColumn("key", F.lit(2**63 - 1))  # one key for all: the cut leaves none
    assert len(language_id._first_of_each(one)) == len(want)
