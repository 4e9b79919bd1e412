import pytest

from marquee.llm import licences
from tests.llm.frames import AWKWARD, CLASHES, documents, with_clashes

NOTICES = [
    ("apache", "// Licensed under the Apache License, Version 2.0 (the \"License\");"), ("mit", "Released under the MIT License."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."), ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("proprietary", "Copyright (c) 2021 Someone. ALL RIGHTS RESERVED."), ("bsd", "SPDX-License-Identifier: BSD-3-Clause"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("lgpl", "Licensed under the GNU Lesser General Public License, version 2.1."),
]
PROSE = ["The house was sold with all of its furniture and the garden behind it.", "She had a driver license and a version of the map.",
         "Permission was given to enter the public square at noon.", "They reserved all seats in the first row.", "Nothing here, 2.0 times over."]


@pytest.fixture(scope="module")
def found(spark):
    rows = [(i, f"{PROSE[i % 5]}\n{PROSE[(i + 1) % 5]}\n{line}", None, None, None) for i, (_, line) in enumerate(NOTICES)]
    rows += [(100 + i, f"{line}\n{line}", None, None, None) for i, line in enumerate(PROSE)]
    rows += [(200 + i, f"word{i} other{i * 7 % 13} thing and the of to in a", None, None, None) for i in range(60)]
    rows += [(r[0] if r[0] is None else 1000 + r[0], *r[1:]) for r in AWKWARD]
    docs = with_clashes(documents(spark, rows), *CLASHES, "notices", "lines", "words")
    return rows, licences.summary(licences.find_notices(docs)).collect()


def test_notices_are_found_in_their_lines(found):
    got = {r.doc_id: r for r in found[1]}
    for i, (family, _) in enumerate(NOTICES):
        assert got[i].families == family, (family, got[i])
        assert [n.paragraph for n in got[i].notices if n.confirmed] == [2]


def test_prose_is_unknown(found):
    assert not [r for r in found[1] if r.doc_id is not None and 100 <= r.doc_id and r.n_confirmed]
    assert len(found[1]) == len(found[0])


def test_plan_is_a_projection_without_python(spark):
    docs = documents(spark)
    model = licences.Classifier(["license"], [[0.0] * licences.BUCKETS for _ in licences.FAMILIES], [0.0] * len(licences.FAMILIES))
    plan = licences.find_notices(docs, model)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    assert licences.find_notices(documents(spark, [])).collect() == []


WRAPPED = {
    "bsd": """Copyright 2021 Someone

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors
may be used to endorse or promote products derived from this software without
specific prior written permission.""",
    "gpl": """/*
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 */
int main() { return 0; }""",
    "mit": """# Permission is hereby granted, free of charge, to any person
# obtaining a copy of this software and associated documentation
# files (the "Software"), to deal in the Software without restriction""",
    "apache": """Licensed under
the Apache

License,
Version 2.0 (the "License");
you may not use
this file except in compliance
with the License.""",
}


def test_wrapped_notices_are_found_with_their_lines(spark):
    rows = [(i, f"{PROSE[i]}\n{text}\n{PROSE[i + 1]}", None, None, None) for i, text in enumerate(WRAPPED.values())]
    rows += [(100 + i, "\n".join(line.split()), None, None, None) for i, line in enumerate(PROSE)]
    rows += [(200 + i, f"word{i} other{i * 7 % 13} thing and the of\nto in a", None, None, None) for i in range(60)]
    got = {r.doc_id: r for r in licences.summary(licences.find_notices(documents(spark, rows))).collect()}
    for i, family in enumerate(WRAPPED):
        assert got[i].families == family, (family, got[i])
    ranges = [[(n.paragraph, n.last_line) for n in got[i].notices if n.confirmed] for i in range(4)]
    assert set(ranges[0]) >= {(3, 4), (6, 7)} and any(13 <= a < b <= 15 for a, b in ranges[0])
    assert (2, 3) in ranges[1] and any(a >= 3 and b == 5 for a, b in ranges[1])
    assert all(1 <= a < b <= 3 for a, b in ranges[2])
    assert all(1 <= a < b <= 8 for a, b in ranges[3])
    assert not [r for r in got.values() if r.doc_id >= 100 and r.n_confirmed]


def test_gates_hold_a_pair_of_every_run_that_confirms():
    for n in range(1, 30):
        pairs = [f"p{i}" for i in range(n)]
        least = min(m for m in range(n + 1) if m / n >= licences.CONTAINED)
        assert len(licences._gate(pairs)) == n - least + 1
