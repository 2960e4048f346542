"""Known sentences in their standard wordings, wrapped and in comments."""

import textwrap

import pytest

from tallyspark.llm import license_scan as L

NOTICE = {
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.""",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.""",
    "GPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    "GPL-2.0-or-later": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy was not given to you, get one.",
}
NOTICE["BSD-3-Clause"] = NOTICE["BSD-2-Clause"] + """

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
SPDX = {"MIT": "MIT", "Apache-2.0": "Apache-2.0", "BSD-3-Clause": "BSD-3-Clause", "BSD-2-Clause": "BSD-2-Clause", "GPL-3.0-only": "GPL-3.0",
        "GPL-2.0-only": "GPL-2.0", "LGPL-3.0-or-later": "LGPL-3.0", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0", "CC-BY-SA-4.0": "CC-BY-SA-4.0",
        "CC-BY-NC-ND-3.0": "CC-BY-NC-ND-3.0"}


def wrap(text, width, mark):
    return "\n".join(mark + line for part in text.split("\n") for line in textwrap.wrap(part, width, break_long_words=False, break_on_hyphens=False) or [""])


def names(spark, texts):
    df = L.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    return [(r.sentence_ids, r.licences) for r in df.orderBy("doc_id").collect()]


@pytest.mark.parametrize("mark", ["", "# ", " * "])
def test_standard_wordings(spark, mark):
    want = [(n, w) for n in NOTICE for w in (40, 75, 10_000)]
    got = names(spark, ["Copyright (c) A. Author\n\n" + wrap(NOTICE[n], w, mark) + "\n\nint main;" for n, w in want])
    assert [x[1] for x in got] == [[n] for n, _ in want]


def test_spdx_lines(spark):
    got = names(spark, [f"// SPDX-License-Identifier: {x}\nint main;" for x in SPDX])
    assert [x[1] for x in got] == [[n] for n in SPDX.values()]


def test_every_known_sentence_wrapped(spark):
    want = [(i, form) for i, forms in L.SENTENCES.items() for form in forms]
    got = names(spark, ["Some words.\n" + wrap(form, 30, "# ") + ".\nMore words." for _, form in want])
    assert [x[0] for x in got] == [f"<{i}>" for i, _ in want]


def test_every_rule(spark):
    rules = [(name, [L.SENTENCES[i][0] for i in ids]) for name, ids in L.RULES]
    got = names(spark, [wrap("\n".join(f"{x}." for x in forms), 60, "# ") for _, forms in rules])
    assert [x[1] for x in got] == [[name] for name, _ in rules]


def test_parts_of_sentences_are_not_taken(spark):
    texts = ["This is not licensed under the MIT license.", "Licensed under the MIT license or another one.", "SPDX-License-Identifier: MIT OR Zlib", "the license", None, ""]
    assert names(spark, texts) == [("", [])] * 6
