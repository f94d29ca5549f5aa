"""An example of every sentence pattern passes the gate of texts and of sentences and gets its identifier."""

from __future__ import annotations

from tillhouse.llm import licenses

EXAMPLES = {
    "spdx-mit": "SPDX-License-Identifier: MIT",
    "spdx-apache2": "SPDX-License-Identifier: Apache-2.0",
    "spdx-gpl2": "SPDX-License-Identifier: GPL-2.0-only",
    "spdx-gpl3": "SPDX-License-Identifier: GPL-3.0-or-later",
    "spdx-bsd3": "SPDX-License-Identifier: BSD-3-Clause",
    "mit-released": "Released under the MIT License.",
    "mit-title": "The MIT License (MIT)",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the 'Software'), to deal in the Software without restriction, including more.",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "as-is-software": "The software is provided 'as is', without warranty of any kind, express or implied.",
    "no-liability": "In no event shall the authors or copyright holders be liable for any claim.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that it stays.",
    "apache2-licensed": "Licensed under the Apache License, Version 2.0.",
    "apache2-title": "Apache License, Version 2.0, January 2004",
    "apache2-compliance": "You may not use this file except in compliance with the License.",
    "apache2-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache2-unless": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an 'AS IS' BASIS, without more.",
    "gpl3-licensed": "Licensed under the GNU General Public License, version 3.",
    "gpl2-licensed": "Licensed under the GNU General Public License, version 2.",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even more.",
    "gpl-received": "You should have received a copy of the GNU General Public License along with this program.",
    "lgpl-licensed": "Licensed under the GNU Lesser General Public License, version 2.1.",
    "mpl2-subject": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, and more.",
    "bsd-endorse": "Neither the name of the owner nor of others may be used to endorse or promote products derived from this.",
    "bsd-as-is": "This software is provided by the owner 'as is' and any express or implied warranties are disclaimed.",
    "cc-by-nc": "This work is released under CC BY-NC 4.0.",
    "cc-by-sa": "Released under Creative\nCommons Attribution-ShareAlike 4.0 International.",
    "cc-by": "This work is released under CC BY 4.0.",
    "cc0": "Released under CC0 1.0 Universal.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "rights-reserved": "All rights\n  reserved.",
    "copyright": "Copr. 2020 A Person",
}
SHORT = [
    ("This work is released under CC BY-NC 4.0.", ["CC-BY-NC-4.0"], "restricted"),
    ("Released under Creative Commons Attribution-NonCommercial 4.0 International.", ["CC-BY-NC-4.0"], "restricted"),
    ("Released under CC0 1.0 Universal.", ["CC0-1.0"], "free"),
    ("All rights reserved elsewhere. This work is released under CC BY-SA 4.0.", ["CC-BY-SA-4.0"], "restricted"),
]


def test_every_pattern_passes_the_gate(docs):
    names = [n for n, _ in licenses.SENTENCES]
    assert list(EXAMPLES) == names
    got = {r["doc_id"]: r["license_sentences"] for r in licenses.scan(docs(list(enumerate(EXAMPLES.values())))).collect()}
    assert got == {i: [n] for i, n in enumerate(names)}


def test_texts_without_a_common_word(docs):
    got = {r["doc_id"]: (r["licenses"], r["license_verdict"]) for r in licenses.scan(docs([(i, t[0]) for i, t in enumerate(SHORT)])).collect()}
    assert got == {i: t[1:] for i, t in enumerate(SHORT)}
