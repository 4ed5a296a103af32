"""License scans: a trained paragraph classifier confirmed by templates.

A paragraph is a run of lines that are not blank; line breaks, comment leaders and
punctuation don't count. Sparse logistic regression (softmax) over hashed word
1- to 3-grams names a licence family or "unknown"; it is trained here, on
the driver, from the notices below with generated variants against prose with licence
words, and its probability is calibrated with a temperature on held-out variants.

A long paragraph would dilute a notice, so what is scored is a passage: the part
of a paragraph that holds a template's word pairs close together, with a few words
around it. An index from word pairs (those that aren't two common words) to templates
finds passages; a passage counts if the classifier is sure of the template's own
family and the passage holds most of the template's pairs.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column
from .kernel import U64, Words, blocks, find_words, member, mix, range_hash, text_buffer, window_hash, window_valid

UNKNOWN = "unknown"
#: Licence families, the SPDX identifiers of each, and notices that stand for it.
SPDX: dict[str, tuple[str, ...]] = {
    "apache-2.0": ("Apache-2.0",), "mit": ("MIT", "MIT-0", "X11"), "isc": ("ISC",),
    "bsd": ("BSD-2-Clause", "BSD-3-Clause", "BSD-4-Clause", "0BSD"),
    "gpl": ("GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"),
    "lgpl": ("LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later"),
    "agpl": ("AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later"), "mpl": ("MPL-1.1", "MPL-2.0"), "epl": ("EPL-1.0", "EPL-2.0"),
    "boost": ("BSL-1.0",), "zlib": ("Zlib",), "unlicense": ("Unlicense",), "wtfpl": ("WTFPL",), "cc0": ("CC0-1.0",),
    "cc-by": ("CC-BY-3.0", "CC-BY-4.0"), "cc-by-sa": ("CC-BY-SA-3.0", "CC-BY-SA-4.0"), "cc-by-nc": ("CC-BY-NC-4.0", "CC-BY-NC-SA-4.0"), "cc-by-nd": ("CC-BY-ND-4.0", "CC-BY-NC-ND-4.0"),
    "ofl": ("OFL-1.1",), "eupl": ("EUPL-1.1", "EUPL-1.2"), "cddl": ("CDDL-1.0", "CDDL-1.1"), "artistic": ("Artistic-1.0", "Artistic-2.0"), "psf": ("PSF-2.0", "Python-2.0"), "postgresql": ("PostgreSQL",),
}
TEMPLATES: dict[str, tuple[str, ...]] = {
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0", "Distributed under the terms of the Apache Software License 2.0", "Released under the Apache License 2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "you may not use this file except in compliance with the License",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "mit": (
        "Released under the MIT License", "Licensed under the MIT licence", "This project is MIT licensed", "This project is licensed under the terms of the MIT license", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "isc": (
        "Released under the ISC License", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation", "Released under the GPL version 2 or later", "Released under the GPL", "Licensed under the GPLv2", "Licensed under the GPLv3", "Licensed under the GNU GPL v2", "Licensed under the GNU GPL v3 or later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see",
    ),
    "lgpl": (
        "licensed under the GNU Lesser General Public License", "under the terms of the GNU Lesser General Public License version 2.1", "Released under the LGPL",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Lesser General Public License along with this library; if not, write to the Free Software Foundation",
    ),
    "agpl": (
        "licensed under the GNU Affero General Public License, version 3", "Released under the AGPL",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Affero General Public License along with this program. If not, see",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted", "Released under the BSD 3-Clause License", "Licensed under the BSD license", "Use of this source code is governed by a BSD-style license",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "Licensed under the Mozilla Public License 2.0",
        "If a copy of the MPL was not distributed with this file, You can obtain one at",
    ),
    "epl": (
        "Licensed under the Eclipse Public License", "This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0 which accompanies this distribution, and is available at",
    ),
    "boost": (
        "Distributed under the Boost Software License, Version 1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software",
    ),
    "zlib": (
        "Released under the zlib License", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    "wtfpl": ("Do What The Fuck You Want To Public License",),
    "cc-by": ("Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    "cc-by-sa": ("Licensed under CC BY-SA 4.0", "Text is available under the Creative Commons Attribution-ShareAlike License", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "Licensed under CC BY-NC-SA 4.0", "licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    "cc-by-nd": ("Licensed under CC BY-ND 4.0", "licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
    "cc0": ("Released under CC0 1.0 Universal", "dedicated to the public domain under CC0", "To the extent possible under law, the author has waived all copyright and related rights"),
    "ofl": (
        "This Font Software is licensed under the SIL Open Font License, Version 1.1", "Licensed under the SIL Open Font License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of the Font Software, to use, study, copy, merge, embed, modify, redistribute, and sell modified and unmodified copies of the Font Software",
    ),
    "eupl": ("Licensed under the EUPL, Version 1.2", "Licensed under the EUPL", "licensed under the European Union Public Licence, version 1.2", "Licensed under the EUPL, Version 1.2 or - as soon they will be approved by the European Commission - subsequent versions of the EUPL"),
    "cddl": ("Licensed under the CDDL", "The contents of this file are subject to the terms of the Common Development and Distribution License", "licensed under the Common Development and Distribution License (CDDL), Version 1.0"),
    "artistic": ("Licensed under the Artistic License 2.0", "you can redistribute it and/or modify it under the terms of the Artistic License", "Released under the Perl Artistic License"),
    "psf": ("Licensed under the Python Software Foundation License Version 2", "Released under the PSF License", "licensed under the Python Software Foundation License"),
    "postgresql": ("Released under the PostgreSQL License", "Licensed under the PostgreSQL License", "This software is released under the PostgreSQL License, a liberal Open Source license"),
    "all-rights-reserved": ("All rights reserved", "Copyright 2020 Example Company. All rights reserved", "No part of this publication may be reproduced without permission", "No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher"),
}
#: Families under which training on a document is commonly allowed.
PERMISSIVE = ("apache-2.0", "mit", "isc", "bsd", "boost", "zlib", "unlicense", "wtfpl", "cc-by", "cc0", "psf", "postgresql")
#: Words that name a family. A template of few words that holds some of them is only found where one of these is said.
NAMES = {
    "apache-2.0": ("apache",), "mit": ("mit",), "isc": ("isc",), "gpl": ("gpl", "gplv2", "gplv3", "gnu"), "lgpl": ("lgpl", "lesser"), "agpl": ("agpl", "affero"), "bsd": ("bsd", "bsd-style"), "mpl": ("mpl", "mozilla"),
    "epl": ("epl", "eclipse"), "boost": ("boost",), "zlib": ("zlib",), "unlicense": ("unencumbered",), "wtfpl": ("fuck",), "cc-by": ("cc", "commons"), "cc-by-sa": ("by-sa", "attribution-sharealike"), "cc-by-nc": ("by-nc", "by-nc-sa", "attribution-noncommercial", "attribution-noncommercial-sharealike"),
    "cc-by-nd": ("by-nd", "attribution-noderivatives"), "cc0": ("cc0",), "ofl": ("font",), "eupl": ("eupl", "european"), "cddl": ("cddl", "development"), "artistic": ("artistic",), "psf": ("psf", "python"), "postgresql": ("postgresql",), "all-rights-reserved": ("reserved",),
}
NAMED_WORDS = 12
#: Words so common that a pair of them points to no template.
COMMON = frozenset("a all an and any are as at be by for form from have if in is it its may not of on one or out so such that the their this to under was which with you your".split())
BITS = 18
NGRAMS = (1, 2, 3)
MIN_PROBABILITY = 0.6
MIN_CONTAINMENT = 0.6
#: Words on either side of a passage that the classifier reads too.
CONTEXT = 4

#: Bytes as they count in a word: lower case, punctuation dropped.
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_PLAIN = b",;:!?()[]{}\"'`*_<>#/%|=~+"
_TO_SPACE = bytes.maketrans(_PLAIN, b" " * len(_PLAIN))


def normal(raw: bytes) -> bytes:
    """Lower case, and punctuation as spaces; the length stays."""
    return raw.translate(_LOWER).translate(_TO_SPACE)


def plain_words(buffer: np.ndarray, offsets: np.ndarray) -> Words:
    """Words without full stops at their end; hyphens alone are none."""
    found = find_words(buffer, offsets)
    end = found.end.copy()
    for _ in range(3):
        dot = (end > found.start + 1) & (buffer[end - 1] == 46) if len(end) else np.zeros(0, bool)
        end[dot] -= 1
    keep = (buffer[found.start] != 45) | (buffer[end - 1] != 45) if len(end) else np.zeros(0, bool)
    return Words(found.start[keep], end[keep], np.searchsorted(found.start[keep], offsets))


def ngrams(buffer: np.ndarray, offsets: np.ndarray):
    """(text, slot) arrays of the n-grams of each order."""
    words = plain_words(buffer, offsets)
    word, doc = range_hash(buffer, words.start, words.end), words.doc()
    for n in NGRAMS:
        h = window_hash(word, n, 30 + n) if n > 1 else word
        ok = window_valid(words.first, n, len(h))
        yield doc[: len(h)][ok], (mix(h + U64(n)) >> U64(64 - BITS)).astype(np.int64)[ok]


@dataclass
class Model:
    families: list[str]
    slots: np.ndarray  # known slots, ascending
    weights: np.ndarray  # (slots + 1, families); the last row is the intercept
    known: np.ndarray  # of every slot
    temperature: float

    def score(self, rows: np.ndarray, slots: np.ndarray, n: int) -> np.ndarray:
        """Calibrated probabilities (n, families)."""
        at = np.searchsorted(self.slots, slots)
        out = np.zeros((n, len(self.families)))
        np.add.at(out, rows, self.weights[at])
        size = np.sqrt(np.maximum(np.bincount(rows, minlength=n), 1))[:, None]  # of known n-grams only
        z = (out / size + self.weights[-1]) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


#: Sentences with licence words that are no notice.
PROSE = (
    "he said all rights are reserved under the terms of the treaty", "the committee reserved all of its rights and left the room", "no part of this building may be entered without permission of the owner",
    "the general public was free to visit the software museum under the terms of the city", "she was licensed to practise in the state and released the results to the public", "the license of the general public was released under rights",
    "a copy of the letter was distributed to any person in the room free of charge", "the source of the river and the form of the valley are subject to change", "use of the bridge is governed by the council and permitted with or without a pass",
    "permission was granted to the authors to visit the archive for any purpose", "the public domain of the internet is not what people think it is", "redistribution of wealth in source countries and binary choices are discussed",
    "the free software movement began when the foundation published its first version", "a driving license or a passport is required by applicable law in most countries", "whether the mit campus or the apache reservation has the older library is unclear",
    "the eclipse was made available to the public on the roof of the school", "works of the mozilla project are described in the public reports of the company", "in no event will the concert be moved and the tickets are provided as is",
    "the attribution of the painting to the master is common but not international", "you may not use this door except in an emergency", "to the extent possible the author has kept the names of the villages",
)
#: Words before a licence's name that make it a mention.
MENTIONS = ("not", "never", "unlike works", "instead of being", "rather than being", "whether it is", "compared with code")


def _variants(seed: int, each: int) -> tuple[list[str], list[str]]:
    """Generated passages and their families, the unknown class among them."""
    rng = random.Random(seed)
    syllables = [a + b for a in "b c d f g h l m n p r s t v st th tr ch".split() for b in "a e i o u an er in on".split()]
    common = "the a of and to in is was for with by that this under terms version released work public general license rights free software source".split()
    prose = " ".join(PROSE).split()
    names = "Example Inc|The Authors|Jane Doe|ACME Corp|contributors".split("|")

    def noise(n: int) -> list[str]:
        return ["".join(rng.choices(syllables, k=rng.randint(1, 3))) if rng.random() < 0.5 else rng.choice(prose if rng.random() < 0.5 else common[:11]) for _ in range(n)]

    texts, families = [], []
    for family, templates in TEMPLATES.items():
        for _ in range(each):
            if family in SPDX and rng.random() < 0.35:
                words = ["SPDX-License-Identifier:", rng.choice(SPDX[family])]
            else:
                words = rng.choice(templates).split()
            for _ in range(len(words) // 12 + (rng.random() < 0.3 and len(words) > 6)):
                del words[rng.randrange(len(words))]
            if len(words) > 24 and rng.random() < 0.3:  # a notice that is cut off
                cut = rng.randrange(len(words) // 3)
                words = words[cut:] if rng.random() < 0.5 else words[: len(words) - cut]
            before = noise(rng.randint(0, CONTEXT)) if rng.random() < 0.6 else []
            after = noise(rng.randint(0, CONTEXT)) if rng.random() < 0.6 else []
            if rng.random() < 0.2:
                before = ["Copyright", "(c)", str(rng.randint(1990, 2025)), rng.choice(names), *before]
            texts.append(" ".join([*before, *words, *after]) + rng.choice(["", "."]))
            families.append(family)
    every = [t.split() for templates in TEMPLATES.values() for t in templates]
    for k in range(each * 12):
        if k % 6 < 2:
            words = noise(rng.randint(1, 60))
            for _ in range(rng.choice([0, 0, 0, 1, 2])):  # licence words out of place
                words.insert(rng.randint(0, len(words)), rng.choice(common))
        elif k % 6 < 4:
            words = noise(rng.randint(0, 6)) + rng.choice(PROSE).split() + noise(rng.randint(0, 6))
        elif k % 6 == 4:  # a template's words in another order
            words = list(rng.choice([t for t in every if len(t) > 8]))
            rng.shuffle(words)
        elif k % 12 == 5:
            texts.append(f"SPDX-License-Identifier {noise(1)[0]}")
            families.append(UNKNOWN)
            continue
        else:
            own = rng.choice([t for t in every if len(t) < 8])
            words = [*rng.choice(MENTIONS).split(), *own, *noise(rng.randint(0, CONTEXT))]
        texts.append(" ".join(words))
        families.append(UNKNOWN)
    return texts, families


def _encoded(texts: list[str] | list[bytes]):
    raw = [normal(t.encode() if isinstance(t, str) else t) for t in texts]
    buffer = np.frombuffer(b"".join(raw), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
    rows, slots = zip(*ngrams(buffer, offsets), strict=True)
    return np.concatenate(rows), np.concatenate(slots)


def train(seed: int = 7, each: int = 120, steps: int = 150) -> Model:
    """Softmax regression with an L1 proximal step, then a temperature on held-out variants."""
    texts, families = _variants(seed, each)
    names = [UNKNOWN, *TEMPLATES]
    y = np.array([names.index(f) for f in families])
    rows, slots = _encoded(texts)
    telling = [t for _, t in _all_templates()]  # n-grams that neither a notice nor a mention holds stay without weight
    telling += [f"{m} {' '.join(t.split()[:3])}" for m in MENTIONS for t in telling if len(t.split()) < 8]
    licensed = np.unique(_encoded(telling)[1])
    keep = np.isin(slots, licensed)
    rows, at, n = rows[keep], np.searchsorted(licensed, slots[keep]), len(texts)
    x = np.zeros((n, len(licensed) + 1), np.float32)
    np.add.at(x, (rows, at), 1)
    x /= np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))
    x[:, -1] = 1
    own = np.arange(n) % 4 != 0
    target = np.eye(len(names), dtype=np.float32)[y]
    w, m, v = (np.zeros((x.shape[1], len(names)), np.float32) for _ in range(3))
    for t in range(1, steps + 1):
        z = x[own] @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        grad = x[own].T @ (p - target[own]) / own.sum()
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w[:-1] = np.sign(w[:-1]) * np.maximum(np.abs(w[:-1]) - 2e-4, 0)
    z = x[~own] @ w

    def loss(temperature: float) -> float:
        s = z / temperature
        s = s - s.max(axis=1, keepdims=True)
        return float(-(s - np.log(np.exp(s).sum(axis=1, keepdims=True)))[np.arange(len(s)), y[~own]].mean())

    temperature = min((0.5, 0.7, 0.85, 1.0, 1.2, 1.5, 2.0, 3.0), key=loss)
    known = np.zeros(1 << BITS, bool)
    known[licensed] = True
    return Model(names, licensed, w.astype(np.float64), known, temperature)


def _all_templates() -> list[tuple[str, str]]:
    marks = [(family, f"SPDX-License-Identifier: {x}") for family, ids in SPDX.items() for x in ids]
    return [(family, t) for family, templates in TEMPLATES.items() for t in templates] + marks


class Templates:
    """Templates as sets of word pairs, and the index from their telling pairs to them."""

    def __init__(self):
        self.families, self.pairs, self.span, self.least, self.names = [], [], [], [], []
        index = []
        for k, (family, text) in enumerate(_all_templates()):
            raw = np.frombuffer(normal(text.encode()), np.uint8)
            words = plain_words(raw, np.array([0, len(raw)]))
            said = [raw[a:b].tobytes().decode() for a, b in zip(words.start.tolist(), words.end.tolist(), strict=True)]
            word = range_hash(raw, words.start, words.end)
            h = window_hash(word, 2, 32)
            own = np.unique(h)
            self.names.append(np.unique(word[[x in NAMES.get(family, ()) for x in said]]) if len(said) <= NAMED_WORDS else word[:0])
            telling = np.unique(h[[not (a in COMMON and b in COMMON) for a, b in zip(said, said[1:], strict=False)]])
            needed = int(np.ceil(MIN_CONTAINMENT * len(own) - 1e-9))
            self.families.append(family)
            self.pairs.append(own)
            self.span.append(3 * len(said) // 2 + 6)
            self.least.append(max(1, needed - (len(own) - len(telling))))
            index += [(x, k) for x in telling.tolist()]
        index.sort()
        self.key, self.template = np.array([x for x, _ in index], U64), np.array([k for _, k in index])


TEMPLATE = Templates()


def passages(flat: np.ndarray, words: Words):
    """(template, first word, last word, containment) of passages that hold enough of a template's pairs; words.first are the paragraphs.

    Telling pairs of one template and paragraph, each within the template's span of the one before it so
    often as the template needs, make a passage, from the first to the last of the template's pairs around them.
    """
    t = TEMPLATE
    word = range_hash(flat, words.start, words.end)
    h = window_hash(word, 2, 32)
    valid = window_valid(words.first, 2, len(h))
    hit = np.flatnonzero(valid & member(h, t.key))
    if not len(hit):
        return
    lo, hi = np.searchsorted(t.key, h[hit]), np.searchsorted(t.key, h[hit], "right")
    at = np.repeat(hit, hi - lo)
    template = t.template[np.repeat(lo, hi - lo) + np.arange(len(at)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo)]
    paragraph = np.searchsorted(words.first, at, "right") - 1
    order = np.lexsort((at, paragraph, template))
    at, template, paragraph = at[order], template[order], paragraph[order]
    least, span = np.array(t.least)[template], np.array(t.span)[template]
    ends = np.arange(len(at)) + least - 1
    inside = ends < len(at)
    ends[~inside] = 0
    ok = inside & (template[ends] == template) & (paragraph[ends] == paragraph) & (at[ends] - at <= span)
    found: list[list[int]] = []
    for k in np.flatnonzero(ok).tolist():
        if found and template[k] == found[-1][0] and paragraph[k] == found[-1][3] and at[k] <= found[-1][2] + 1:
            found[-1][2] = int(at[ends[k]])
        else:
            found.append([int(template[k]), int(at[k]), int(at[ends[k]]), int(paragraph[k])])
    for k, first, last, own in found:
        begin = max(int(words.first[own]), first - t.span[k])
        stop = min(int(words.first[own + 1]) - 1, last + 1 + t.span[k])
        mine = np.flatnonzero(member(h[begin:stop], t.pairs[k]))
        mine = mine[(begin + mine >= first - len(t.pairs[k])) & (begin + mine <= last + len(t.pairs[k]))]
        like = len(np.unique(h[begin:stop][mine])) / len(t.pairs[k])
        said = word[begin + int(mine[0]) : begin + int(mine[-1]) + 2] if len(mine) else word[:0]
        if like >= MIN_CONTAINMENT and (not len(t.names[k]) or member(said, t.names[k]).any()):
            yield k, begin + int(mine[0]), begin + int(mine[-1]) + 1, like


def paragraphs(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the texts' paragraphs begin, and the text of each."""
    begins = np.union1d(offsets[:-1][np.diff(offsets) > 0], np.flatnonzero(flat == 10) + 1)
    begins = begins[begins < len(flat)].astype(np.int64)
    lines = find_words(flat, np.append(begins, len(flat)))
    full = np.diff(lines.first) > 0
    doc = np.searchsorted(offsets, begins, "right") - 1
    new = full.copy()
    new[1:] &= ~full[:-1] | (doc[1:] != doc[:-1])
    return begins[new], doc[new]


def notices(texts: list[bytes], found: list[tuple], model: Model):
    """Of passages (template, first, last, containment), in texts: those that the classifier confirms, one for each place."""
    if not found:
        return
    rows, slots = _encoded(texts)
    known = model.known[slots]
    p = model.score(rows[known], slots[known], len(texts))
    best = p.argmax(axis=1)
    good = []
    for k, (t, first, last, like) in enumerate(found):
        family = TEMPLATE.families[t]
        if model.families[best[k]] == family and p[k, best[k]] >= MIN_PROBABILITY:
            good.append((-len(TEMPLATE.pairs[t]) * like, first, last, family, float(p[k, best[k]]), like))
    taken: list[tuple[int, int, str]] = []
    for _, first, last, family, sure, like in sorted(good):  # the one that explains most pairs first
        if all(last <= a or first >= b or last - first <= 3 and other != family and (first, last) != (a, b) and like == 1 for a, b, other in taken):
            taken.append((first, last, family))
            yield first, family, sure, like


def scan_paragraphs(texts: pa.Array, model: Model):
    """(row, paragraph number, family, probability, containment) of the notices, and each text's paragraph count."""
    buffer, offsets = text_buffer(texts)
    found, counts = [], np.zeros(len(offsets) - 1, np.int64)
    for lo, hi, b, o in blocks(buffer, offsets):
        flat = np.frombuffer(normal(b.tobytes()), np.uint8)
        begins, doc = paragraphs(flat, o)
        counts[lo:hi] = np.bincount(doc, minlength=hi - lo)
        if not len(begins):
            continue
        words = plain_words(flat, np.append(begins, len(flat)))
        seen: dict[int, list] = {}
        for x in passages(flat, words):
            seen.setdefault(int(np.searchsorted(words.first, x[1], "right")) - 1, []).append(x)
        first = np.searchsorted(doc, np.arange(hi - lo))
        for at, own in sorted(seen.items()):
            cut = []
            for _, a, z, _ in own:  # the words around it, but not those of a neighbouring passage
                left = max([int(words.first[at]), a - CONTEXT, *(y + 1 for _, _, y, _ in own if y < a)])
                right = min([int(words.first[at + 1]) - 1, z + CONTEXT, *(x - 1 for _, x, _, _ in own if x > z)])
                cut.append((left, right))
            said = [flat[words.start[a] : words.end[z]].tobytes() for a, z in cut]
            for _, *rest in notices(said, own, model):
                found.append((lo + int(doc[at]), at - int(first[doc[at]]), *rest))
    return found, counts


def scan(docs: DataFrame, model: Model | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: doc_id, n_paragraphs, n_licensed, families, family, probability, containment, permissive.

    n_paragraphs counts runs of lines that are not blank, n_licensed the notices in them.
    families: the distinct families, sorted, joined by commas ("" if none);
    family: that of the most probable paragraph ("unknown" if none), with its
    probability and template containment (null if none); permissive: at
    least one family, and all of them permissive. Null, empty or blank text has no
    paragraphs; a long text is one block of its own, whose arrays grow with it. Null and repeated doc_ids keep their rows; no documents, no rows;
    other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model or train())
    names = ["doc_id", "n_paragraphs", "n_licensed", "families", "family", "probability", "containment", "permissive"]

    def run(batches):
        own = shared.value
        for batch in batches:
            found, counts = scan_paragraphs(column(batch, "text"), own)
            per: dict[int, list] = {}
            for row, *rest in found:
                per.setdefault(row, []).append(rest)
            rows = []
            for d in range(batch.num_rows):
                hits = per.get(d, [])
                families = sorted({h[1] for h in hits})
                top = max(hits, key=lambda h: (h[2], h[3], -h[0]), default=(0, UNKNOWN, None, None))
                rows.append((int(counts[d]), len(hits), ",".join(families), *top[1:], bool(families) and all(f in PERMISSIVE for f in families)))
            types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.bool_())
            cols = list(zip(*rows, strict=True)) if rows else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names=names)

    schema = T._parse_datatype_string("n_paragraphs long, n_licensed long, families string, family string, probability double, containment double, permissive boolean")
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), *schema.fields])
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)
