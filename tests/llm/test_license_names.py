"""Short notices are told apart by the licence's name, not by the words around it."""

from __future__ import annotations

import pytest

from threatlake.llm import licenses

NOTICES = {
    "Licensed under the Python Software Foundation License Version 2": "psf",
    "Licensed under the EUPL, Version 1.2": "eupl",
    "This Font Software is licensed under the SIL Open Font License, Version 1.1.": "ofl",
    "The contents of this file are subject to the terms of the Common Development and Distribution License": "cddl",
    "Licensed under the Artistic License 2.0": "artistic",
    "Released under the PostgreSQL License": "postgresql",
    "This library is released under the MIT licence.": "mit",
    "Licensed under the GNU GPL v2": "gpl",
    "Licensed under the Apache License, Version 2.0": "apache-2.0",
    "SPDX-License-Identifier: OFL-1.1": "ofl",
    "SPDX-License-Identifier: Artistic-2.0": "artistic",
    "Licensed under the Foobar Sharing Agreement, Version 2.0": "",
    "Licensed under the Quux Public Covenant": "",
    "Released under the Example Corporation Terms": "",
    "Distributed under the terms of the Widget Makers Charter 2.0": "",
}


@pytest.fixture(scope="module")
def model():
    return licenses.train()


def test_names(spark, model):
    table = spark.createDataFrame(list(enumerate(NOTICES)), "doc_id long, text string")
    got = {r.doc_id: r.families for r in licenses.scan(table, model).collect()}
    assert {t: got[k] for k, t in enumerate(NOTICES)} == NOTICES
