"""Licence templates beyond those of the SQL check: notices, common wordings and whole texts.

Names start with an SPDX id. Whole texts are the files of `license_texts`, named by
their SPDX id, and the short ones below.
"""

from __future__ import annotations

from itertools import product
from pathlib import Path

_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT '
    "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. "
)
_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the Software), to deal in the Software without restriction, including "
    "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
    "copies of the Software, and to permit persons to whom the Software is furnished to do so"
)
_MIT_END = (
    "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
    "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
    "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
    "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
    "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. "
)
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission. "
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR "
    "ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
    "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
    "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF "
    "ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted"
)
_ISC_END = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
    "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE "
    "FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM "
    "LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
    "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)

# Whole texts of the short licences.
SHORT_TEXTS = {
    "0BSD": f"{_ISC_GRANT}. {_ISC_END}",
    "BSD-2-Clause": _BSD_HEAD + _BSD_END,
    "BSD-3-Clause": _BSD_HEAD + _BSD_NAMES + _BSD_END,
    "BSL-1.0": (
        "Boost Software License - Version 1.0 - August 17th, 2003 Permission is hereby granted, free of charge, "
        "to any person or organization obtaining a copy of the software and accompanying documentation covered "
        "by this license (the Software) to use, reproduce, display, distribute, execute, and transmit the "
        "Software, and to prepare derivative works of the Software, and to permit third-parties to whom the "
        "Software is furnished to do so, all subject to the following: The copyright notices in the Software "
        "and this entire statement, including the above license grant, this restriction and the following "
        "disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative "
        "works of the Software, unless such copies or derivative works are solely in the form of "
        "machine-executable object code generated by a source language processor. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND "
        "NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE "
        "LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT "
        "OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "ISC": (
        f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all "
        f"copies. {_ISC_END}"
    ),
    "MIT": (
        f"{_GRANT}, subject to the following conditions: The above copyright notice and this permission notice "
        f"shall be included in all copies or substantial portions of the Software. {_AS_IS}{_MIT_END}"
    ),
    "MIT-0": f"{_GRANT}. {_AS_IS}{_MIT_END}",
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
        "modify, publish, use, compile, sell, or distribute this software, either in source code form or as a "
        "compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions "
        "that recognize copyright laws, the author or authors of this software dedicate any and all copyright "
        "interest in the software to the public domain. We make this dedication for the benefit of the public "
        "at large and to the detriment of our heirs and successors. We intend this dedication to be an overt "
        "act of relinquishment in perpetuity of all present and future rights to this software under copyright "
        f"law. {_AS_IS}IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
        "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to "
        "https://unlicense.org"
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the "
        "authors be held liable for any damages arising from the use of this software. Permission is granted to "
        "anyone to use this software for any purpose, including commercial applications, and to alter it and "
        "redistribute it freely, subject to the following restrictions: 1. The origin of this software must not "
        "be misrepresented; you must not claim that you wrote the original software. If you use this software "
        "in a product, an acknowledgment in the product documentation would be appreciated but is not required. "
        "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the "
        "original software. 3. This notice may not be removed or altered from any source distribution."
    ),
}

# How licences are named in notices, by SPDX id.
NAMES = {
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "AGPL-3.0 License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0 License"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License"],
    "BSL-1.0": ["Boost Software License, Version 1.0"],
    "CC0-1.0": ["CC0 1.0 Universal", "Creative Commons CC0 1.0 Universal Public Domain Dedication"],
    "EPL-1.0": ["Eclipse Public License, version 1.0", "Eclipse Public License v1.0"],
    "EPL-2.0": ["Eclipse Public License, version 2.0", "Eclipse Public License v2.0"],
    "GFDL-1.3": ["GNU Free Documentation License, Version 1.3"],
    "GPL-2.0": ["GNU General Public License, version 2", "GPL-2.0 License"],
    "GPL-3.0": ["GNU General Public License, version 3", "GPL-3.0 License"],
    "ISC": ["ISC License"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "LGPL-2.1 License"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "LGPL-3.0 License"],
    "MIT": ["MIT License"],
    "MPL-1.1": ["Mozilla Public License, version 1.1"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License, v. 2.0"],
    "Zlib": ["zlib License"],
}
_FRAMES = (
    "Licensed under the {}.",
    "Released under the {}.",
    "Distributed under the {}.",
    "This work is licensed under the {}.",
    "This project is licensed under the {}.",
    "under the terms of the {}",
)
_CC = {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC": "Attribution-NonCommercial",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
# The licence that "This program is free software" names, with its version.
_GNU = {
    "AGPL-3.0": ("GNU Affero General Public License", "3"),
    "GPL-2.0": ("GNU General Public License", "2"),
    "GPL-3.0": ("GNU General Public License", "3"),
    "LGPL-2.1": ("GNU Lesser General Public License", "2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License", "3"),
}


def general_templates() -> dict[str, str]:
    found = {f"{spdx} whole": text for spdx, text in SHORT_TEXTS.items()}
    for file in sorted((Path(__file__).parent / "license_texts").iterdir()):
        found[f"{file.name} whole"] = file.read_text()
    for spdx, names in NAMES.items():
        for i, (frame, name) in enumerate(product(_FRAMES, names), 1):
            found[f"{spdx} notice {i}"] = frame.format(name)
    for (code, name), version in product(_CC.items(), ("3.0", "4.0")):
        long = f"Creative Commons {name} {version}"
        found[f"CC-{code}-{version} notice 1"] = f"Licensed under CC {code} {version}."
        found[f"CC-{code}-{version} notice 2"] = f"This work is licensed under CC {code} {version}."
        found[f"CC-{code}-{version} notice 3"] = f"This work is licensed under a {long} International License."
        found[f"CC-{code}-{version} notice 4"] = f"Licensed under the {long} License."
    for spdx, (name, version) in _GNU.items():
        for subject, frame in product(("program", "library"), ("either version", "version")):
            later = "of the License, or (at your option) any later version." if "either" in frame else "of the License."
            found[f"{spdx} header {subject} {frame}"] = (
                f"This {subject} is free software: you can redistribute it and/or modify it under the terms of "
                f"the {name} as published by the Free Software Foundation, {frame} {version} {later}"
            )
    found["MPL-2.0 header"] = (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
        "MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    )
    found["EPL-2.0 header"] = (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public "
        "License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"
    )
    found["CC0-1.0 dedication"] = (
        "To the extent possible under law, the author has waived all copyright and related or neighboring "
        "rights to this work."
    )
    found["Unlicense notice"] = "This is free and unencumbered software released into the public domain."
    found["BSD notice"] = "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."
    return found
