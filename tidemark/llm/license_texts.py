"""The templates of the registered license scan: whole licence texts, standard headers and short notices.

Whole texts are files in ``licences``, by name; the permissive licences, headers and notices are here. A name in brackets tells the form.
"""

from __future__ import annotations

from pathlib import Path

_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
_MIT = f"""{_GRANT} (the "Software"), to deal
in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
_REDISTRIBUTION = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
_BSD_2 = f"""{_REDISTRIBUTION}:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution."""
_BSD_NO_NAMES = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software
without specific prior written permission."""
_BSD_ADVERTISING = """
3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software
developed by the organization."""
_BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE
LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS
OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF
USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE."""
_UNLICENSE = """This is free and unencumbered software released into the public domain.
Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
purpose, commercial or non-commercial, and by any means.
In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public
domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an
overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising
from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote
the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or
altered from any source distribution."""
_BOOST = """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered
by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software,
and to permit third-parties to whom the Software is furnished to do so, all subject to the following"""
_AGPL_13 = """Notwithstanding any other provision of this License, if you modify the Program, your modified version must prominently offer all users interacting
with it remotely through a computer network (if your version supports such interaction) an opportunity to receive the Corresponding Source of your version by
providing access to the Corresponding Source from a network server at no charge, through some standard or customary means of facilitating copying of software."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy
of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is
distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
permissions and limitations under the License."""


def _gnu(name: str, version: str, only: bool = False) -> str:
    either = f"version {version} of the License" if only else f"either version {version} of the License, or (at your option) any later version"
    return f"""is free software; you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation; {either}."""


def _creative(name: str, version: str) -> str:
    return f"This work is licensed under a Creative Commons {name} {version} International License"


HEADERS = {
    "MIT (whole text)": _MIT, "MIT (text)": _GRANT, "BSD (text)": _REDISTRIBUTION, "BSD-2-Clause (text)": _BSD_2 + _BSD_END,
    "BSD-3-Clause (text)": _BSD_2 + _BSD_NO_NAMES + _BSD_END, "BSD-4-Clause (text)": _BSD_2 + _BSD_ADVERTISING + _BSD_NO_NAMES.replace("3.", "4.") + _BSD_END,
    "ISC (text)": _ISC, "Unlicense (text)": _UNLICENSE, "Zlib (text)": _ZLIB, "BSL-1.0 (text)": _BOOST, "AGPL-3.0 (section 13)": _AGPL_13,
    "Apache-2.0 (header)": _APACHE,
    "MPL-2.0 (header)": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this "
                        "file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    **{f"{key} (header)": _gnu(name, version) for key, name, version in (
        ("GPL-2.0-or-later", "General Public License", "2"), ("GPL-3.0-or-later", "General Public License", "3"),
        ("LGPL-2.1-or-later", "Lesser General Public License", "2.1"), ("LGPL-3.0-or-later", "Lesser General Public License", "3"),
        ("AGPL-3.0-or-later", "Affero General Public License", "3"))},
    **{f"{key} (header)": _gnu(name, version, True) for key, name, version in (
        ("GPL-2.0-only", "General Public License", "2"), ("GPL-3.0-only", "General Public License", "3"))},
}
#: Short notices.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3",
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3",
    "MPL-2.0": "Licensed under the Mozilla Public License, Version 2.0",
    "MIT": "Released under the MIT License",
    "ISC": "Released under the ISC License",
    "BSD": "Released under the BSD License",
    "Unlicense": "Released into the public domain under the Unlicense",
    "CC0-1.0": "Licensed under CC0 1.0 Universal",
    "CC-BY-4.0 (short)": "Licensed under CC BY 4.0",
    "CC-BY-SA-4.0 (short)": "Licensed under CC BY-SA 4.0",
    "CC-BY-4.0": _creative("Attribution", "4.0"),
    "CC-BY-SA-4.0": _creative("Attribution-ShareAlike", "4.0"),
    "CC-BY-SA-3.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License",
    "CC-BY-NC-4.0 (long)": _creative("Attribution-NonCommercial", "4.0"),
    "CC-BY-NC-SA-4.0": _creative("Attribution-NonCommercial-ShareAlike", "4.0"),
    "CC-BY-ND-4.0": _creative("Attribution-NoDerivatives", "4.0"),
}
#: Phrases that a copy must hold, as licences differ by them alone: all of those parted by ";", any of those parted by "|".
KEYS = {
    "Apache-2.0": "apache", "CC-BY-NC-4.0": "cc by nc 4", "CC-BY-4.0 (short)": "cc by 4", "CC-BY-SA-4.0 (short)": "cc by sa 4", "CC0-1.0": "cc0 1",
    "GPL-3.0": "the gnu general public", "GPL-2.0": "the gnu general public", "LGPL-3.0": "gnu lesser general public",
    "LGPL-2.1": "gnu lesser general public;2 1", "AGPL-3.0": "gnu affero general public", "MPL-2.0": "mozilla public", "MIT": "mit", "ISC": "isc", "BSD": "bsd",
    "Unlicense": "unlicense", "CC-BY-4.0": "commons attribution 4", "CC-BY-SA-4.0": "commons attribution sharealike 4",
    "CC-BY-SA-3.0": "commons attribution sharealike 3", "CC-BY-NC-4.0 (long)": "commons attribution noncommercial 4",
    "CC-BY-NC-SA-4.0": "commons attribution noncommercial sharealike 4", "CC-BY-ND-4.0": "commons attribution noderivatives 4",
    "BSD-2-Clause (text)": "with the distribution this software is provided", "BSD-4-Clause (text)": "all advertising materials",
    "BSD-3-Clause (text)": "with the distribution neither the name|with the distribution 3 neither the name|with the distribution c neither the name",
    "GPL-2.0-or-later (header)": "gnu general public;either version 2", "GPL-3.0-or-later (header)": "gnu general public;either version 3",
    "LGPL-2.1-or-later (header)": "gnu lesser general public;either version 2 1", "LGPL-3.0-or-later (header)": "gnu lesser general public;either version 3",
    "AGPL-3.0-or-later (header)": "gnu affero general public;either version 3", "GPL-2.0-only (header)": "gnu general public;foundation version 2",
    "GPL-3.0-only (header)": "gnu general public;foundation version 3", "GPL-3 (text)": "use with the gnu affero general public license",
    "LGPL-2 (text)": "gnu library general public license", "LGPL-2.1 (text)": "gnu lesser general public license",
}


def whole_texts() -> dict[str, str]:
    return {f"{p.stem} (text)": p.read_text("utf-8", "replace") for p in sorted((Path(__file__).parent / "licences").glob("*.txt"))}


def shipped() -> dict[str, str]:
    return whole_texts() | HEADERS | NOTICES
