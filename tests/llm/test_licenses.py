import pytest

from motolake.llm import licenses
from tests.oracle import same

LINES = {
    "Released under the MIT License.": "MIT",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "This work is licensed under the GNU General Public License, version 3.": "GPL",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC",
    "This text is available under CC BY 4.0": "CC-BY",
    "Distributed under the terms of the BSD 3-Clause License": "BSD",
    "SPDX-License-Identifier: MPL-2.0": "MPL-2.0",
    "All rights reserved.": "proprietary",
    "ALL RIGHTS RESERVED": "proprietary",
    "This library is under the GNU Lesser General Public License, version 3.": "LGPL",
}
OTHERS = ["My driving license has expired.", "The license of the bar was refused.", "Copyright law is old.", "They licensed the film."]


def found(df):
    return {r["doc_id"]: r["licences"] for r in licenses.scan(df).collect()}


def test_families_and_unknown(make):
    lines = [*LINES, *OTHERS]
    out = found(make(list(enumerate(lines))))
    for i, line in enumerate(lines):
        assert [x["family"] for x in out[i]] == [LINES.get(line, "unknown")], line
        assert all(0 <= x["probability"] <= 1 for x in out[i])


def test_paragraphs_of_long_texts(make):
    text = "\n".join([*["some words of the text go here"] * 3000, "Released under the MIT License.", "x " * 20_000 + "All rights reserved."])
    out = licenses.scan(make([(1, text)])).first()
    assert out["n_paragraphs"] == 3002
    assert [(x["paragraph"], x["family"]) for x in out["licences"]] == [(3000, "MIT"), (3001, "proprietary")]


def test_nulls_repeats_and_empty(make):
    out = licenses.scan(make([(1, None), (2, ""), (3, "\n \n"), (4, "Released under the MIT License."), (4, "Released under the MIT License."), (None, "All rights reserved.")])).collect()
    assert len(out) == 6 and sorted(r["n_paragraphs"] for r in out) == [0, 0, 0, 1, 1, 1]
    assert licenses.scan(make([])).count() == 0


def test_no_python_on_the_executors(make):
    plan = licenses.scan(make([(1, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_query_gives_what_sql_gives(spark, sf_dir):
    same(licenses.op6_licenses(spark, sf_dir), licenses.oracle_sql(), sf_dir)


def test_model_is_the_same_every_time():
    first = licenses.model()
    licenses.model.cache_clear()
    assert licenses.model() == first and first["classes"][-1] == "unknown"
    assert sum(len(v) for v in first["weights"].values()) == len(first["weights"]) * len(first["classes"])


@pytest.mark.parametrize("family", licenses.FAMILIES)
def test_every_name_is_found(make, family):
    names = licenses.FAMILIES[family]
    out = found(make([(i, f"Licensed under {n}." if family != "proprietary" else f"{n}.") for i, n in enumerate(names)]))
    assert sum(x[0]["family"] == family for x in out.values()) >= len(names) - 1


MIT_WRAPPED = """Copyright 2020 the authors

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The sun rose over the hills."""
GPL_WRAPPED = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version."""
NOTICES = {
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:": ["BSD"],
    "Permission is hereby granted, free of charge, to any person obtaining a copy": ["MIT"],
    "Released under Apache-2.0": ["Apache-2.0"],
    "Distributed under the terms of MIT.": ["MIT"],
    "it under the terms of the GNU General Public License as published by": ["GPL"],
    MIT_WRAPPED: ["unknown", "MIT"],
    GPL_WRAPPED: ["GPL"],
    "Licensed under the Apache License,\nVersion 2.0 as everybody knows.": ["Apache-2.0"],
    "Unless required by applicable law or agreed to in writing, software\ndistributed under the License is distributed on an \"AS IS\" BASIS,\nWITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.": ["Apache-2.0"],
    "Released under the MIT License and\nso is this: All rights reserved": ["MIT", "proprietary"],
    "Ich gehe mit dir, sie geht mit ihm.\nShe works at MIT and lives in Boston.\nThe software is provided to all students.": [],
}


def test_notices_texts_and_wrapped_paragraphs(make):
    out = found(make(list(enumerate(NOTICES))))
    assert {i: [x["family"] for x in out[i]] for i in out} == dict(enumerate(NOTICES.values()))
    assert [x["paragraph"] for x in out[list(NOTICES).index(MIT_WRAPPED)]] == [0, 2]


def test_gate_excludes_nothing_that_reaches_the_overlap():
    import random
    import re

    rng, gate = random.Random(3), re.compile(licenses.gate(0.75))
    for vs in licenses.full_model()["variants"].values():
        for v in vs:
            words = [g for g in v if " " not in g]
            for _ in range(20):
                gone = set(rng.sample(words, rng.randrange(len(words))))
                left = [g for g in v if not set(g.split()) & gone]
                if len(left) >= 0.75 * len(v):
                    assert gate.search(" , ".join(left)), v
            bare = [g for g in v if not gate.search(g)]
            assert len(bare) < 0.75 * len(v)


def test_own_texts_are_found(make):
    from motolake.llm.notices import BODIES

    rows = [(c, p) for c, ps in (licenses.NOTICES | {"Apache-2.0": BODIES["Apache-2.0"], "MPL-2.0": BODIES["MPL-2.0"]}).items() for p in ps]
    out = found(make([(i, p) for i, (_, p) in enumerate(rows)]))
    hits = sum(any(x["family"] == c for x in out[i]) for i, (c, _) in enumerate(rows))
    assert hits >= 0.95 * len(rows)
