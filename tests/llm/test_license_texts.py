"""Licence texts as they usually stand in files, wrapped and numbered."""

from __future__ import annotations

import pytest

from tillhouse.llm import licenses

BSD = """Copyright (c) 2020, A Person
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
{third}
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES.
"""
THIRD = """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM.
"""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
GPL = """This program is free software{mark} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version {n} of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program{end}
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES.
"""
GPL_IDS = ["gpl-free", "gpl-hope", "gpl-received"]
TEXTS = [
    ("MIT License\n\nCopyright (c) 2020 A Person\n\n" + GRANT, ["MIT"], "free", ["mit-grant", "mit-notice", "as-is-software", "no-liability"]),
    ("Copyright (c) 2020 A Person\n" + GRANT, ["MIT"], "free", ["copyright", "mit-grant", "mit-notice"]),
    (BSD.format(third=THIRD), ["BSD-3-Clause"], "free", ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is"]),
    (BSD.format(third=""), ["BSD-2-Clause"], "free", ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-as-is"]),
    (" ".join(BSD.format(third=THIRD).split()), ["BSD-3-Clause"], "free", ["bsd-source", "bsd-binary", "bsd-endorse", "bsd-as-is"]),
    (APACHE, ["Apache-2.0"], "free", ["apache2-licensed", "apache2-compliance", "apache2-copy", "apache2-unless"]),
    ("                                 Apache License\n                           Version 2.0, January 2004\n", ["Apache-2.0"], "free", ["apache2-title"]),
    (GPL.format(mark=":", n=3, end=".  If not, see <https://www.gnu.org/licenses/>."), ["GPL"], "restricted", GPL_IDS),
    (GPL.format(mark=";", n=2, end="; if not, write to the Free Software Foundation."), ["GPL"], "restricted", GPL_IDS),
    (ISC, ["ISC"], "free", ["isc-grant"]),
    ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed\nwith this file, You can obtain one.", ["MPL-2.0"], "restricted", ["mpl2-subject"]),
    ("Notes. 5. Released under the MIT License.", ["MIT"], "free", ["mit-released"]),
]
TAGS = [("MIT", "MIT"), ("Apache-2.0", "Apache-2.0"), ("GPL-2.0", "GPL-2.0"), ("GPL-2.0-only", "GPL-2.0"), ("GPL-2.0-or-later", "GPL-2.0"), ("GPL-2.0+", "GPL-2.0")]
TAGS += [("GPL-3.0-only", "GPL-3.0"), ("GPL-3.0-or-later", "GPL-3.0"), ("BSD-3-Clause", "BSD-3-Clause")]
SHAPES = ["SPDX-License-Identifier: {}", "// SPDX-License-Identifier: {}\nint main() {{", "/* SPDX-License-Identifier: {} */\n#include", "A file. SPDX-License-Identifier: {}\nSome text follows"]


def test_usual_texts(docs):
    got = {r["doc_id"]: r for r in licenses.scan(docs([(i, t[0]) for i, t in enumerate(TEXTS)])).collect()}
    for i, (_, names, verdict, ids) in enumerate(TEXTS):
        assert (got[i]["licenses"], got[i]["license_verdict"]) == (names, verdict), (i, got[i])
        assert set(ids) <= set(got[i]["license_sentences"]), (i, got[i])


@pytest.mark.parametrize("shape", SHAPES)
def test_every_spdx_tag(docs, shape):
    got = {r["doc_id"]: r["licenses"] for r in licenses.scan(docs([(i, shape.format(tag)) for i, (tag, _) in enumerate(TAGS)])).collect()}
    assert got == {i: [name] for i, (_, name) in enumerate(TAGS)}
