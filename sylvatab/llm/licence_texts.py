"""Templates of licences: whole texts of the short ones, the notices that files carry
of the long ones, and single sentences that are common by themselves. Fixed values."""

from __future__ import annotations

MIT = """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including
without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial
portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO
EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN
AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE
OR OTHER DEALINGS IN THE SOFTWARE.
"""

ISC = """
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE
INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR
ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE,
DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN
CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""

BSD_CONDITIONS = """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution.
"""

BSD_ENDORSEMENT = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or
promote products derived from this software without specific prior written permission.
"""

BSD_DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY
DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE
OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
DAMAGE.
"""

UNLICENSE = """
This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source
code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all
copyright interest in the software to the public domain. We make this dedication for the benefit of the
public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt
act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO
EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
DEALINGS IN THE SOFTWARE.
"""

ZLIB = """
This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and
to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original
software. If you use this software in a product, an acknowledgment in the product documentation would be
appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the
original software.
3. This notice may not be removed or altered from any source distribution.
"""

APACHE_NOTICE = """
Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is
distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See
the License for the specific language governing permissions and limitations under the License.
"""

MPL_NOTICE = """
This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.
"""

EPL_NOTICE = """
This program and the accompanying materials are made available under the terms of the Eclipse Public License
2.0 which is available at https://www.eclipse.org/legal/epl-2.0/
"""

CC0_NOTICE = """
To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring
rights to this software to the public domain worldwide. This software is distributed without any warranty.
You should have received a copy of the CC0 Public Domain Dedication along with this software. If not, see
http://creativecommons.org/publicdomain/zero/1.0/.
"""

#: Notice of the licences of one family, which differ in name and version.
GNU_NOTICE = """
This program is free software: you can redistribute it and/or modify it under the terms of the {name} as
published by the Free Software Foundation, either version {version} of the License, or (at your option) any
later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details.

You should have received a copy of the {name} along with this program. If not, see
<https://www.gnu.org/licenses/>.
"""
GNU_NAMES = {
    "gpl": ("GNU General Public License", ["2", "3"]),
    "lgpl": ("GNU Lesser General Public License", ["2.1", "3"]),
    "agpl": ("GNU Affero General Public License", ["3"]),
}

#: Parts of the names of the Creative Commons licences.
CC_NAMES = {
    "cc-by": "Attribution",
    "cc-by-sa": "Attribution-ShareAlike",
    "cc-by-nd": "Attribution-NoDerivatives",
    "cc-by-nc": "Attribution-NonCommercial",
    "cc-by-nc-sa": "Attribution-NonCommercial-ShareAlike",
    "cc-by-nc-nd": "Attribution-NonCommercial-NoDerivatives",
}

SENTENCES = {
    "mit": [
        "released under the mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and"
        " associated documentation files the software to deal in the software without restriction",
    ],
    "apache-2": [
        "licensed under the apache license version 2 0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
    ],
    "cc-by-nc": ["licensed under cc by nc 4 0"],
    "gpl-3": ["this work is licensed under the gnu general public license version 3"],
    "bsd": [
        "redistribution and use in source and binary forms with or without modification are permitted provided"
        " that the following conditions are met",
    ],
    "mpl-2": ["subject to the terms of the mozilla public license v 2 0"],
    "all-rights-reserved": ["all rights reserved"],
}


def templates() -> dict[str, list[str]]:
    """All templates by label. A name without a version has a label of its own
    where versions of it exist."""
    found = {label: list(texts) for label, texts in SENTENCES.items()}

    def add(label: str, *texts: str) -> None:
        found.setdefault(label, []).extend(texts)

    add("mit", MIT)
    add("isc", ISC)
    add("bsd-2", BSD_CONDITIONS + BSD_DISCLAIMER)
    add("bsd-3", BSD_CONDITIONS + BSD_ENDORSEMENT + BSD_DISCLAIMER)
    add("unlicense", UNLICENSE)
    add("zlib", ZLIB)
    add("apache-2", APACHE_NOTICE)
    add("mpl-2", MPL_NOTICE)
    add("epl-2", EPL_NOTICE)
    add("cc0", CC0_NOTICE)
    for family, (name, versions) in GNU_NAMES.items():
        add(family, f"under the terms of the {name}")
        for version in versions:
            label = f"{family}-{version}"
            add(label, GNU_NOTICE.format(name=name, version=version), f"under the terms of the {name} version {version}")
    for label, name in CC_NAMES.items():
        add(label, f"Creative Commons {name} 4.0 International License")
    return found
