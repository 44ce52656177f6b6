import duckdb
import numpy as np
import pytest
import regex

from claimloom.llm import licences as q


# Notices and other sentences that the generator does not know.
HELD = [
 ("apache", "Licensed to the Apache Software Foundation (ASF) under one or more\n * contributor license agreements.  The ASF licenses this file to You under the Apache License, Version 2.0\n * (the \"License\"); you may not use this file except in compliance with\n * the License."),
 ("apache", "# Copyright 2019 The Authors\n# Licensed under the Apache License, Version 2.0 (the \"License\");\n# you may not use this file except in compliance with the License."),
 ("apache", "This project is made available under the Apache 2.0 license"),
 ("apache", "Code samples are licensed under the Apache 2.0 License"),
 ("mit", "Use of this source code is governed by an MIT-style license\nthat can be found in the LICENSE file"),
 ("mit", "This project is licensed under the terms of the MIT license"),
 ("mit", "Permission is hereby granted, free of charge, to any person obtaining\na copy of this software and associated documentation files (the\n\"Software\"), to deal in the Software without restriction, including\nwithout limitation the rights to use, copy, modify, merge, publish"),
 ("mit", "MIT licensed. See LICENSE for details"),
 ("gpl", "This file is free software; you can redistribute it and/or modify it under the terms of the GNU\nGeneral Public License as published by the Free Software Foundation; either\nversion 2 of the License, or (at your option) any later version"),
 ("gpl", "Distributed under the terms of the GNU General Public License v2"),
 ("gpl", "Released under GPLv3; GNU General Public License version 3 or later"),
 ("lgpl", "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License"),
 ("agpl", "published under the GNU Affero General Public License version 3, AGPL for short"),
 ("bsd", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file"),
 ("bsd", "Redistributions of source code must retain the above copyright notice, this list of\nconditions and the following disclaimer"),
 ("bsd", "Released under the BSD 3-Clause License"),
 ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this file"),
 ("cc-by", "Content on this site is licensed under a Creative Commons Attribution 4.0 International license"),
 ("cc-by", "Figures are available under CC BY 4.0"),
 ("cc-by-sa", "Available under the Creative Commons Attribution-ShareAlike License; additional terms may apply"),
 ("cc-by-sa", "Shared under CC BY-SA 4.0 by the wiki's contributors"),
 ("cc-by-nc", "This article is published under a Creative Commons Attribution-NonCommercial 4.0 licence, CC BY-NC 4.0"),
 ("cc0", "To the extent possible under law, the author has dedicated all copyright to the public domain worldwide under CC0 1.0"),
 ("cc0", "The data are released into the public domain under CC0"),
 ("isc", "Permission to use, copy, modify, and distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice"),
 ("proprietary", "Copyright 2020 Example Ltd. All rights reserved. No part of this publication may be reproduced, stored or transmitted\nwithout prior written permission of the publisher"),
 ("mit", "See the LICENSE file for license rights and limitations (MIT)"),
 ("mit", "SPDX-License-Identifier: MIT AND nothing else"),
 ("apache", "The library is open source and uses the Apache license, version 2"),
 ("gpl", "is free software under version 3 of the GNU General Public\nLicense, without any warranty"),
 ("lgpl", "Linking is allowed by the GNU Lesser General Public License (LGPL), version 3"),
 ("agpl", "The server is covered by the GNU AGPL, version 3 or any later version"),
 ("bsd", "Copyright (c) 2011, J. Roe. Simplified BSD License, two clauses"),
 ("mpl", "Files in this folder are under the MPL, version 2.0, of the Mozilla Foundation"),
 ("cc-by-nc", "Photographs: CC-BY-NC 4.0, no commercial use"),
 ("isc", "Code by J. Roe, under the ISC license; see COPYING"),
 ("proprietary", "All rights reserved. No part may be copied or reproduced in any form"),
]
OTHER = ["The mit of the glove was lost.", "Apache helicopters flew over the public square.", "The general public may visit the foundation on Sunday.", "He was granted permission to use the car free of charge.", "Version 3 of the paper was published without the figures.", "Creative people share common interests.", "The source of the river is subject to seasonal terms.", "A copy of the letter was distributed with the file.", "The domain name was released to the public.", "International attribution of the attack took four years."]


def paragraphs(text):
    return regex.split(q.BREAK, text)


@pytest.fixture(scope="module")
def model():
    return q.trained()


def test_held_out_accuracy(model):
    rng = np.random.default_rng(99)
    filler = ["river", "stone", "walk", "the", "of", "license", "version", "code"]
    texts, labels = q._paragraphs(rng, 1500, model.families, filler)
    found = [model.scan(t)[0] for t in texts]
    names = [*model.families, q.UNKNOWN]
    right = np.array([f == names[k] for f, k in zip(found, labels)])
    other = labels == len(model.families)
    assert right[other].mean() > 0.985 and right[~other].mean() >= 0.9


def test_notices_outside_the_generator(model):
    assert not {n for _, n in HELD} & {n for _, n in q.NOTICES}
    found = [model.scan(n)[0] for _, n in HELD]
    assert sum(f == family for f, (family, _) in zip(found, HELD)) >= 0.9 * len(HELD)
    assert all(f in (family, q.UNKNOWN) for f, (family, _) in zip(found, HELD))
    assert {model.scan(o)[0] for o in OTHER} == {q.UNKNOWN}


def test_wrapped_notices_are_one_paragraph(spark, model):
    wrapped = [(n, f"Some words before.\n{' '.join(t.split())}\n\nLater words".replace(", ", ",\n * ").replace(" of ", " of\n * ")) for n, (_, t) in enumerate(q.NOTICES) if len(t.split()) > 8]
    found = {r.doc_id: (r.paragraph, r.family) for r in q.scan(spark.createDataFrame(wrapped, "doc_id int, text string")).collect()}
    assert found == {n: (1, q.NOTICES[n][0]) for n, _ in wrapped}


def test_whole_notices_and_others(model):
    for family, notice in q.NOTICES:
        for text in (notice, notice.upper(), f"Some words before it. {notice} And more words after it."):
            named, p, share = model.scan(text)
            assert named == family and p >= model.threshold and share >= q.CONFIRMED, text
    for text in (*q.OTHERS, "", "plain words", "license", "Version 3.0"):
        assert model.scan(text)[0] == q.UNKNOWN, text


def test_weights_are_sparse(model):
    assert (model.weights == 0).mean() > 0.4
    assert model.bias.argmax() == len(model.families)


def test_frame_against_the_plain_form(spark, model):
    texts = [None, "", "\n\n", "x\n" + q.NOTICES[0][1] + "\n\nmore", "license version public " * 3000, q.NOTICES[4][1] + "\n" + q.NOTICES[7][1], *q.OTHERS, *(n for _, n in q.NOTICES)]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(3, texts[3], "x", 1), (None, texts[3], "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, family string, words int")
    found = sorted((str(r.doc_id), r.paragraph, r.family, round(r.probability, 6), round(r.similarity, 6), r.confirmed) for r in q.scan(docs).collect())
    expected = []
    for i, t, *_ in rows:
        for k, line in enumerate(paragraphs(t or "")):
            family, p, share = model.scan(line)
            if family != q.UNKNOWN:
                expected.append((str(i), k, family, round(p, 6), round(share, 6), share >= q.CONFIRMED))
    assert found == sorted(expected) and len(found) > len(q.NOTICES)
    assert q.scan(docs.limit(0)).collect() == []
    plan = q.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_driver_rows(spark):
    at = "/root/testdata/sf0.01/documents.parquet"
    found = {(r.doc_id, r.paragraph): r.family for r in q.scan(spark.read.parquet(at)).filter("confirmed").collect()}
    expected = {}
    for i, text in duckdb.sql(f"SELECT doc_id, text FROM '{at}'").fetchall():
        for k, line in enumerate(paragraphs(text)):
            for mark, family in (("MIT License", "mit"), ("Apache License", "apache"), ("GNU General Public", "gpl"), ("CC BY-NC", "cc-by-nc")):
                if mark in line:
                    expected[i, k] = family
    assert found == expected and len(found) > 10
