"""Texts of common licences, one-line notices, and spellings that count as equal."""

from __future__ import annotations

import re
from pathlib import Path

# The published licence texts, without title and copyright line.
_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_AUTHOR_DISCLAIMER = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_START = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
_BSD_END = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

LICENCES = {
    "MIT": _MIT_GRANT,
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n" + _AUTHOR_DISCLAIMER,
    "0BSD": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n" + _AUTHOR_DISCLAIMER,
    "BSD-2-Clause": f"{_BSD_START}\n{_BSD_END}",
    "BSD-3-Clause": f"{_BSD_START}\n{_BSD_NAMES}\n{_BSD_END}",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
}


def _unwrapped(text: str) -> str:
    """A published text with every paragraph on one line, as above."""
    return "\n\n".join(" ".join(paragraph.split()) for paragraph in re.split(r"\n\s*\n", text))


# Long licences, one file each, named as the licence.
LICENCES |= {file.stem: _unwrapped(file.read_text()) for file in sorted((Path(__file__).parent / "licence_data").glob("*.txt"))}

# Notices that are a line, or a text, of their own.
NOTICES = {
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "Licensed under CC BY 4.0.": "CC-BY-4.0",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0",
    "Released under the MIT License.": "MIT",
    "All rights reserved.": "all-rights-reserved",
}

# Spellings that count as equal, in canonical form (lower case, no punctuation).
SPELLINGS = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "authoris": "authoriz", "catalogue": "catalog", "centre": "center",
    "copyright owner": "copyright holder", "favour": "favor", "fulfilment": "fulfillment", "initialis": "initializ", "judgement": "judgment",
    "labelling": "labeling", "labour": "labor", "licence": "license", "merchantibility": "merchantability", "non infringement": "noninfringement",
    "organis": "organiz", "per cent": "percent", "programme": "program", "recognis": "recogniz", "sub license": "sublicense", "utilis": "utiliz", "whilst": "while",
}

# Words, in canonical form, that begin a licence or a condition and so end a copyright statement before them.
STATEMENT_ENDS = [
    "all use", "as is", "do not", "everyone is permitted", "except as", "free use", "licensed under", "may not", "may only", "must not", "no part",
    "no permission", "no warranty", "not for", "permission is", "permission to", "permitted", "preamble", "prohibited", "provided", "redistribution", "released under",
    "shall", "subject to", "terms and conditions", "this document", "this file", "this is", "this library", "this license", "this program", "this software",
    "this work", "under the terms", "unless", "use of", "without", "you are", "you can", "you may", "you must",
]
