"""Licence signature rules: names of licences times the phrases they stand in.

Every rule is a regular expression over *normal* text: lower-case words joined by single blanks, punctuation
gone (``Apache License, Version 2.0`` reads ``apache license version 2 0``).
"""

from __future__ import annotations

# Label, word that must occur (the prefilter), and how the licence is named.
NAMES = [
    ("mit", "mit", "mit"),
    ("mit-0", "mit", "mit (?:0|no attribution)"),
    ("apache-1", "apache", "apache(?: software)?(?: license)?(?: version)? 1(?: [01])?"),
    ("apache-2", "apache", "apache(?: software)?(?: license)?(?: version)? 2(?: 0)?"),
    ("apache", "apache", "apache(?: software)?"),
    ("gpl-1", "gpl", "(?:gnu )?gpl ?(?:version |v)?1(?: 0)?(?: only| or later)?"),
    ("gpl-2", "gpl", "(?:gnu )?gpl ?(?:version |v)?2(?: 0)?(?: only| or later)?"),
    ("gpl-2", "gplv2", "(?:gnu )?gplv2"),
    ("gpl-3", "gpl", "(?:gnu )?gpl ?(?:version |v)?3(?: 0)?(?: only| or later)?"),
    ("gpl-3", "gplv3", "(?:gnu )?gplv3"),
    ("gpl", "gpl", "(?:gnu )?gpl"),
    ("gpl", "general", "(?:gnu )?general public"),
    ("gpl-2", "general", "(?:gnu )?general public license(?: as published by the free software foundation)?(?: either)? (?:version |v)2(?: 0)?"),
    ("gpl-3", "general", "(?:gnu )?general public license(?: as published by the free software foundation)?(?: either)? (?:version |v)3(?: 0)?"),
    ("lgpl-2", "lgpl", "(?:gnu )?lgpl ?(?:version |v)?2(?: [01])?(?: only| or later)?"),
    ("lgpl-3", "lgpl", "(?:gnu )?lgpl ?(?:version |v)?3(?: 0)?(?: only| or later)?"),
    ("lgpl", "lgpl", "(?:gnu )?lgpl"),
    ("lgpl", "lesser", "(?:gnu )?lesser general public"),
    ("agpl-3", "agpl", "(?:gnu )?agpl ?(?:version |v)?3(?: 0)?(?: only| or later)?"),
    ("agpl", "affero", "(?:gnu )?affero general public"),
    ("bsd-0", "0bsd", "0bsd"),
    ("bsd-2", "bsd", "(?:bsd 2(?: clause)?|2 clause bsd|simplified bsd)"),
    ("bsd-3", "bsd", "(?:bsd 3(?: clause)?|3 clause bsd|(?:new|modified|revised) bsd)"),
    ("bsd-4", "bsd", "(?:bsd 4(?: clause)?|4 clause bsd|original bsd)"),
    ("bsd", "bsd", "bsd(?: style)?"),
    ("isc", "isc", "isc"),
    ("mpl-1", "mozilla", "mozilla public(?: license)?(?: version)? 1(?: [01])?"),
    ("mpl-2", "mozilla", "mozilla public(?: license)?(?: version)? 2(?: 0)?"),
    ("mpl-2", "mpl", "mpl ?(?:version |v)?2(?: 0)?"),
    ("mpl", "mozilla", "mozilla public"),
    ("epl-1", "eclipse", "eclipse public(?: license)?(?: version)? 1(?: 0)?"),
    ("epl-2", "eclipse", "eclipse public(?: license)?(?: version)? 2(?: 0)?"),
    ("epl", "epl", "epl(?: [12](?: 0)?)?"),
    ("cddl", "cddl", "cddl(?: 1(?: [01])?)?"),
    ("cddl", "distribution", "common development and distribution"),
    ("cpl", "common", "common public(?: license)?(?: 1 0)?"),
    ("eupl", "eupl", "eupl(?: 1(?: [012])?)?"),
    ("artistic-1", "artistic", "artistic(?: license)?(?: version)? 1(?: 0)?"),
    ("artistic-2", "artistic", "artistic(?: license)?(?: version)? 2(?: 0)?"),
    ("artistic", "artistic", "artistic"),
    ("zlib", "zlib", "zlib(?: libpng)?"),
    ("libpng", "libpng", "libpng(?: 2 0)?"),
    ("boost", "boost", "boost(?: software)?(?: license)?(?: version)?(?: 1(?: 0)?)?"),
    ("unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl(?: version 2)?"),
    ("ms-pl", "microsoft", "microsoft public"),
    ("ms-rl", "microsoft", "microsoft reciprocal"),
    ("ofl", "ofl", "(?:sil )?ofl(?: 1(?: [01])?)?"),
    ("ofl", "font", "(?:sil )?open font"),
    ("php", "php", "php(?: license)?(?: version)?(?: 3(?: 0?1)?)?"),
    ("python", "python", "python(?: software foundation)?"),
    ("ruby", "ruby", "ruby"),
    ("openssl", "openssl", "openssl"),
    ("postgresql", "postgresql", "postgresql"),
    ("w3c", "w3c", "w3c(?: software)?"),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa"),
    ("vim", "vim", "vim"),
    ("x11", "x11", "x11"),
    ("beerware", "beerware", "beerware"),
    ("upl", "upl", "upl(?: 1 0)?"),
    ("odbl", "odbl", "odbl(?: 1 0)?"),
    ("odbl", "database", "open (?:data commons open )?database"),
    ("cc0", "cc0", "cc0(?: 1(?: 0)?)?(?: universal)?"),
    ("cc-by", "cc", "cc by(?: [1234](?: [05])?)?"),
    ("cc-by-sa", "cc", "cc by sa(?: [1234](?: [05])?)?"),
    ("cc-by-nd", "cc", "cc by nd(?: [1234](?: [05])?)?"),
    ("cc-by-nc", "cc", "cc by nc(?: [1234](?: [05])?)?"),
    ("cc-by-nc-sa", "cc", "cc by nc sa(?: [1234](?: [05])?)?"),
    ("cc-by-nc-nd", "cc", "cc by nc nd(?: [1234](?: [05])?)?"),
    ("cc-by", "creative", "creative commons attribution(?: [1234] [05])?"),
    ("cc-by-sa", "creative", "creative commons attribution share ?alike(?: [1234] [05])?"),
    ("cc-by-nd", "creative", "creative commons attribution no ?deriv(?:ative)?s(?: [1234] [05])?"),
    ("cc-by-nc", "creative", "creative commons attribution non ?commercial(?: [1234] [05])?"),
    ("cc", "creative", "creative commons"),
]

# Priority (1 wins), word that must occur, phrase; ``{}`` is the name.
PHRASES = [
    (1, "spdx", "spdx license identifier {}"),
    (2, "licensed", "licen[cs]ed under (?:the |an? )?(?:terms of )?(?:the )?{}(?: licen[cs]e)?"),
    (2, "terms", "(?:under|subject to) the terms (?:and conditions )?of (?:the |an? )?{}(?: licen[cs]e)?"),
    (2, "released", "released under (?:the |an? )?{}(?: licen[cs]e)?"),
    (2, "distributed", "distributed under (?:the |an? )?{}(?: licen[cs]e)?"),
    (2, "available", "available under (?:the |an? )?{}(?: licen[cs]e)?"),
    (3, "license", "{} license"),
]

# Whole sentences that name no licence or belong to one text; label, two words, priority, pattern.
SENTENCES = [
    ("mit", "permission", "charge", 2, "permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "permission", "fee", 2, "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("bsd", "redistribution", "binary", 2, "redistribution and use in source and binary forms"),
    ("public-domain", "public", "domain", 3, "(?:released into|placed in|dedicated to) the public domain"),
    ("proprietary", "rights", "reserved", 3, "all rights reserved"),
    ("proprietary", "unauthorized", "prohibited", 2, "unauthorized (?:copying|use|reproduction|distribution)(?: of this (?:file|work|text))?(?: .{0,40})? is (?:strictly )?prohibited"),
]

# The phrases every scan must find, and their labels.
BASE = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]

WEIGHT = {1: 1.0, 2: 0.9, 3: 0.6}


def rules() -> list[tuple[int, str, int, str, str, str]]:
    """(rule number, label, priority, first word, second word, pattern), by priority and then in written order."""
    made = [(label, rank, word, key, phrase.format(name)) for rank, key, phrase in PHRASES for label, word, name in NAMES]
    made += [(label, rank, one, two, pattern) for label, one, two, rank, pattern in SENTENCES]
    made.sort(key=lambda r: r[1])
    return [(i, label, rank, one, two, f" {pattern}(?= )") for i, (label, rank, one, two, pattern) in enumerate(made)]
