"""Texts of common licences and one-line notices, as pairs of an SPDX identifier and a text.

Fixed values: the wording of the licences is their authors'.  Copyright lines, punctuation, case and
line ends do not matter to the scan, so they are left out or kept plain.  Long texts are the files of
``license_files``, named by identifier; the driver reads them.  Of AGPL-3.0-only, CC-BY-4.0, CC-BY-SA-4.0
and CC-BY-NC-4.0 there are notices only.
"""

from pathlib import Path

FILES = Path(__file__).parent / "license_files"
END_OF_TERMS = "END OF TERMS AND CONDITIONS"
# Copies of the Unlicense have it or not.
UNLICENSE_LINK = "For more information, please refer to <http://unlicense.org/>"
# Where the Apache licence's appendix leaves room for a copyright line.
APACHE_BLANK = "Copyright [yyyy] [name of copyright owner]"

_AS_IS = """IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY,
WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE
USE OR OTHER DEALINGS IN THE SOFTWARE."""

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. """ + _AS_IS

_ISC_TAIL = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY
SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR
PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH
THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted"""
ISC = _ISC_GRANT + ", provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _ISC_TAIL
ZERO_BSD = _ISC_GRANT + ".\n\n" + _ISC_TAIL

_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.

"""
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
BSD_2 = _BSD_HEAD + _BSD_TAIL
BSD_3 = _BSD_HEAD + """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse
or promote products derived from this software without specific prior written permission.

""" + _BSD_TAIL

ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter
it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original
software.

3. This notice may not be removed or altered from any source distribution."""

APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
specific language governing permissions and limitations under the License."""

TEXTS = [("MIT", MIT), ("MIT", "MIT License\n\n" + MIT), ("ISC", ISC), ("ISC", "ISC License\n\n" + ISC),
         ("0BSD", ZERO_BSD), ("BSD-2-Clause", BSD_2), ("BSD-3-Clause", BSD_3), ("Zlib", ZLIB),
         ("Zlib", "zlib License\n\n" + ZLIB), ("Apache-2.0", APACHE_HEADER)]

NAMES = [("MIT", "MIT License"), ("ISC", "ISC License"), ("0BSD", "BSD Zero Clause License"),
         ("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-3-Clause", "BSD 3-Clause License"), ("Zlib", "zlib License"),
         ("Apache-2.0", "Apache License, Version 2.0"), ("MPL-2.0", "Mozilla Public License, version 2.0"),
         ("GPL-2.0-only", "GNU General Public License, version 2"),
         ("GPL-3.0-only", "GNU General Public License, version 3"),
         ("LGPL-3.0-only", "GNU Lesser General Public License, version 3"),
         ("AGPL-3.0-only", "GNU Affero General Public License, version 3"),
         ("CC-BY-4.0", "CC BY 4.0"), ("CC-BY-SA-4.0", "CC BY-SA 4.0"), ("CC-BY-NC-4.0", "CC BY-NC 4.0"),
         ("CC0-1.0", "CC0 1.0"), ("Unlicense", "Unlicense")]
PHRASES = ["{}", "Licensed under {}", "Licensed under the {}", "Released under {}", "Released under the {}",
           "This work is licensed under {}", "This work is licensed under the {}"]


def listed() -> list[tuple[str, str]]:
    """Short texts, notices of a name in a phrase, and identifier lines."""
    notices = [(i, p.format(name)) for i, name in NAMES for p in PHRASES]
    tags = [(i, f"SPDX-License-Identifier: {i}") for i, _ in NAMES]
    return TEXTS + notices + tags


def long_texts() -> list[tuple[str, str]]:
    """Whole texts from files: as they are, without what follows the terms, with the copyright line of the
    appendix filled in or the link added, and each of these with links by https."""
    made = []
    for path in sorted(FILES.glob("*.txt")):
        text = path.read_text(encoding="utf-8")
        forms = [text, text.replace(APACHE_BLANK, "Copyright 2004 X")]
        if END_OF_TERMS in text:
            terms = text[:text.index(END_OF_TERMS)]
            forms += [terms, terms + END_OF_TERMS]
        if path.stem == "Unlicense":
            forms.append(text + UNLICENSE_LINK)
        forms += [form.replace("http://", "https://") for form in forms]
        made += [(path.stem, form) for form in dict.fromkeys(forms)]
    return made


def known() -> list[tuple[str, str]]:
    """All pairs."""
    return listed() + long_texts()
