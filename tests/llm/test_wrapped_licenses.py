"""Licence notices: wrapped, in comments, in long lines, next to each other, and none."""

from __future__ import annotations

import re

import pytest

from threatlake.llm import licenses

GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""
LGPL = """This library is licensed under the GNU Lesser
General Public License, see the file for it."""
BSD = """Redistribution and use in source and binary
forms, with or without modification,
are permitted provided that the following conditions are met:"""
MIT = """Permission is hereby granted, free of charge, to
any person obtaining a copy
of this software and associated documentation files"""
NARROW = "\n".join("Redistribution and use in source and binary forms with or without modification are permitted".split())


def test_wrapped_notices(docs):
    prose = "He went to the house\nof the river and was under the\nterms that all of them had.\n"
    rows = [(1, GPL), (2, LGPL), (3, BSD), (4, MIT), (5, f"{prose}{GPL}\n{prose}"), (6, prose), (7, "All rights\n\nreserved"), (8, NARROW)]
    got = {r.doc_id: (r.families, r.n_licensed) for r in licenses.scan(docs(rows)).collect()}
    assert got == {1: ("gpl", 1), 2: ("lgpl", 1), 3: ("bsd", 1), 4: ("mit", 1), 5: ("gpl", 1), 6: ("", 0), 7: ("", 0), 8: ("bsd", 1)}


AGPL = """# it under the terms of the GNU Affero General Public License as
# published by the Free Software Foundation, either version 3 of the
# License, or (at your option) any later version. You can redistribute it and/or modify it"""
APACHE = """ * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""
EPL = """// This program and the accompanying materials are made
// available under the terms of the Eclipse Public License v2.0
// which accompanies this distribution, and is available at"""
BSD3 = """Copyright 2020 The Authors. All rights reserved.
Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

 1. Redistributions of source code must retain the above copyright notice,
    this list of conditions and the following disclaimer."""


@pytest.mark.parametrize(
    ("text", "families"),
    [
        (AGPL, "agpl"), (APACHE, "apache-2.0"), (ISC, "isc"), (EPL, "epl"), (BSD3, "all-rights-reserved,bsd"), ("This is free and unencumbered software\nreleased into the public domain.", "unlicense"),
        ("word " * 300 + "Released under the MIT License. " + "the of and " * 200, "mit"), ("-- SPDX-License-Identifier: LGPL-2.1-or-later", "lgpl"), ("/* SPDX-License-Identifier: Apache-2.0 */", "apache-2.0"),
        ("SPDX-License-Identifier: Foo-1.0", ""), (" ".join(["GNU Lesser General Public License"] * 2), ""), ("Licensed under CC BY-ND 4.0", "cc-by-nd"), ("x " * 200_000 + GPL, "gpl"),
        # prose with a notice's words
        ("He said all rights are reserved under the terms of the treaty that the general public signed.", ""), ("Use of the bridge is governed by the council, with or without a pass.", ""),
        ("The MIT campus and the Apache reservation released a license.", ""), ("Permission was hereby granted to visit the archive, free of charge, to any person in the room.", ""),
        ("software free is this: the redistribute modify General Public License GNU terms of", ""), ("We may not use this file; it is not in the archive.", ""),
    ],
)
def test_notices(docs, text, families):
    assert licenses.scan(docs([(1, text)])).first().families == families


def plain_scan(text, model):
    """The families of a text: every template tried on every paragraph, word by word."""
    t, out = licenses.TEMPLATE, set()
    told = []
    for family, template in licenses._all_templates():
        words = plain(template)
        pairs = list(zip(words, words[1:], strict=False))
        told.append((family, {*pairs}, {p for p in pairs if not licenses.COMMON.issuperset(p)}, 3 * len(words) // 2 + 6))
    for paragraph in re.split(r"\n(?:[ \t\r\f\v]*\n)+", text or ""):
        words = plain(paragraph)
        pairs = list(zip(words, words[1:], strict=False))
        found = []
        for k, (_, own, telling, span) in enumerate(told):
            hits = [n for n, p in enumerate(pairs) if p in telling]
            need = t.least[k]
            runs = [(a, hits[n + need - 1]) for n, a in enumerate(hits) if n + need <= len(hits) and hits[n + need - 1] - a <= span]
            merged = []
            for a, z in runs:
                if merged and a <= merged[-1][1] + 1:
                    merged[-1][1] = z
                else:
                    merged.append([a, z])
            for a, z in merged:
                at = [n for n in range(max(0, a - span, a - len(own)), min(len(pairs), z + 1 + span, z + len(own) + 1)) if pairs[n] in own]
                like = len({pairs[n] for n in at}) / len(own)
                if like >= licenses.MIN_CONTAINMENT:
                    found.append((k, at[0], at[-1] + 1, like))
        texts = []
        for _, a, z, _ in found:
            left = max([0, a - licenses.CONTEXT, *(y + 1 for _, _, y, _ in found if y < a)])
            right = min([len(words) - 1, z + licenses.CONTEXT, *(x - 1 for _, x, _, _ in found if x > z)])
            texts.append(" ".join(words[left : right + 1]).encode())
        out |= {family for _, family, *_ in licenses.notices(texts, found, model)}
    return ",".join(sorted(out))


def plain(text):
    spaced = text.translate({ord(c): " " for c in licenses._PLAIN.decode()})
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in spaced)) if w]
    words = [w[: max(1, len(w) - min(3, len(w) - len(w.rstrip("."))))] for w in words]
    return [w for w in words if not (w[0] == w[-1] == "-")]


PLANTED = {"Licensed under the Apache License, Version 2.0.": "apache-2.0", "Released under the MIT License.": "mit", "This work is licensed under the GNU General Public License, version 3.": "gpl", "All rights reserved.": "all-rights-reserved", "Licensed under CC BY-NC 4.0.": "cc-by-nc"}


def test_whole_table(spark):
    """Every text of the table, against the plain scan and against the lines that the data plants."""
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = licenses.train()
    got = {r.doc_id: r.families for r in licenses.scan(table, model).collect()}
    rows = table.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    wrong = [(r.doc_id, got[r.doc_id], want) for r in rows if got[r.doc_id] != (want := plain_scan(r.text, model))]
    assert not wrong
    for r in rows:
        lines = {PLANTED[x] for x in (r.text or "").split("\n") if x in PLANTED}
        assert got[r.doc_id] == ",".join(sorted(lines))
