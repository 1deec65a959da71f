"""Common licenses: full texts, in ``licenses/``, and the notices that name them in other texts."""

from __future__ import annotations

from pathlib import Path

#: Full texts, by file name. Of EPL, AGPL and the CC licenses but CC0 only notices are known.
FULL = (
    "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0",
    "MIT", "MPL-2.0", "Unlicense", "Zlib",
)

_GNU = (
    "This {it} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} "
    "as published by the Free Software Foundation, either version {n} of the License, or (at your option) any "
    "later version",
    "{it} is free software; you can redistribute it and/or modify it under the terms of the GNU {kind} as "
    "published by the Free Software Foundation; version {n} of the License only",
    "This {it} is distributed under the terms of the GNU {kind} version {n}",
    "Licensed under the GNU {kind} version {n}",
    "Released under the GNU {kind} v{n}",
    "You should have received a copy of the GNU {kind} version {n} along with this {it}",
)
_GNU_KINDS = (
    ("GPL-2.0", "General Public License", "program", "2"),
    ("GPL-3.0", "General Public License", "program", "3"),
    ("LGPL-2.1", "Lesser General Public License", "library", "2.1"),
    ("LGPL-3.0", "Lesser General Public License", "library", "3"),
    ("AGPL-3.0", "Affero General Public License", "program", "3"),
)
_CC_KINDS = (
    ("CC-BY", "Attribution"),
    ("CC-BY-SA", "Attribution-ShareAlike"),
    ("CC-BY-NC", "Attribution-NonCommercial"),
    ("CC-BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    ("CC-BY-ND", "Attribution-NoDerivatives"),
    ("CC-BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
)
_NAMED = (
    ("Apache-2.0", "Apache License 2.0"),
    ("MIT", "MIT License"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("ISC", "ISC License"),
    ("MPL-2.0", "Mozilla Public License 2.0"),
    ("EPL-1.0", "Eclipse Public License 1.0"),
    ("EPL-2.0", "Eclipse Public License 2.0"),
    ("Zlib", "zlib License"),
)
_OTHER = (
    ("MIT", "Released under an MIT License"),
    ("MIT", "Available under the MIT License"),
    ("EPL-1.0", "All rights reserved. This program and the accompanying materials are made available under the "
     "terms of the Eclipse Public License v1.0 which accompanies this distribution"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse "
     "Public License 2.0 which is available at"),
    ("Unlicense", "This is free and unencumbered software released into the public domain"),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring "
     "rights to this work"),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0"),
    ("CC0-1.0", "Licensed under CC0 1.0 Universal"),
    ("BSD", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file"),
)


def notices() -> list[tuple[str, str]]:
    out = []
    for name, kind, it, n in _GNU_KINDS:
        out += [(name, text.format(kind=kind, it=it, n=n)) for text in _GNU]
    for name, kind in _CC_KINDS:
        for version in ("3.0", "4.0"):
            spdx, port = f"{name}-{version}", "Unported" if version == "3.0" else "International"
            out.append((spdx, f"This work is licensed under a Creative Commons {kind} {version} {port} License"))
            out.append((spdx, f"Licensed under the Creative Commons {kind} {version} {port} License"))
            out.append((spdx, f"Licensed under {name.replace('-', ' ', 1)} {version}"))
    for name, text in _NAMED:
        for start in ("Licensed under the", "This project is released under the", "Distributed under the terms of the"):
            out.append((name, f"{start} {text}"))
    return out + list(_OTHER)


def full_texts() -> list[tuple[str, str]]:
    return [(name, (Path(__file__).parent / "licenses" / f"{name}.txt").read_text("utf-8")) for name in FULL]


def known(first: tuple[tuple[str, str], ...]) -> tuple[tuple[str, str], ...]:
    """``first`` and all others, each wording of a license once."""
    return tuple(dict.fromkeys([*first, *notices(), *full_texts()]))
