"""License signatures written one by one: short names after "license", version letters, glued forms, bare names, body phrases.

Each is (label, gate, pattern over normalised words, priority, confidence); see ``licenses``. A pattern stands for itself and shares
no template; those that would catch everyday words say what must not follow.
"""

from __future__ import annotations

LISTED = (
    # "License: MIT" and the like: a short name behind the word, as package files write it
    ("mit", (" mit ",), "licen[cs]es? mit(?! (?:der|dem|den|des|die|das|ein|eine|einer|einem|mir|dir|ihm|ihr|uns|euch|ihnen|freundlichen))", 72, 0.9),
    ("mit", (" expat",), "licen[cs]e expat", 72, 0.9),
    ("apache-2", ("apache",), "licen[cs]e apache(?: v?2(?: 0)?)", 72, 0.9),
    ("apache", ("apache",), "licen[cs]e apache(?! v?[0-9])", 71, 0.7),
    ("apache-2", (" asl ",), "licen[cs]e asl 2(?: 0)?", 72, 0.85),
    ("gpl-2", ("gpl",), "licen[cs]e (?:gnu )?gpl v?2(?: 0)?(?: only)?", 72, 0.9),
    ("gpl-3", ("gpl",), "licen[cs]e (?:gnu )?gpl v?3(?: 0)?(?: only)?", 72, 0.9),
    ("gpl-2", ("gplv2",), "licen[cs]e gplv2(?: 0)?", 73, 0.9),
    ("gpl-3", ("gplv3",), "licen[cs]e gplv3(?: 0)?", 73, 0.9),
    ("gpl", (" gpl ",), "licen[cs]e (?:gnu )?gpl(?! v?[0-9])", 71, 0.85),
    ("lgpl-2", (" lgpl ",), "licen[cs]e (?:gnu )?lgpl v?2(?: [01])?", 72, 0.9),
    ("lgpl-3", (" lgpl ",), "licen[cs]e (?:gnu )?lgpl v?3(?: 0)?", 72, 0.9),
    ("lgpl", (" lgpl ",), "licen[cs]e (?:gnu )?lgpl(?! v?[0-9])", 71, 0.85),
    ("agpl-3", (" agpl ",), "licen[cs]e (?:gnu )?agpl(?: v?3(?: 0)?)?", 72, 0.9),
    ("bsd-2", (" bsd ",), "licen[cs]e (?:bsd 2 clause|2 clause bsd|simplified bsd)", 72, 0.9),
    ("bsd-3", (" bsd ",), "licen[cs]e (?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)", 72, 0.9),
    ("bsd-4", (" bsd ",), "licen[cs]e (?:bsd 4 clause|4 clause bsd|original bsd)", 72, 0.9),
    ("bsd", (" bsd ",), "licen[cs]e bsd(?! [0-9])", 71, 0.8),
    ("bsd-0", ("0bsd",), "licen[cs]e 0bsd", 72, 0.9),
    ("isc", (" isc ",), "licen[cs]e isc", 72, 0.9),
    ("mpl-2", (" mpl ",), "licen[cs]e mpl v?2(?: 0)?", 72, 0.9),
    ("mpl-1", (" mpl ",), "licen[cs]e mpl v?1 [01]", 72, 0.9),
    ("epl-1", (" epl ",), "licen[cs]e epl v?1(?: 0)?", 72, 0.9),
    ("epl-2", (" epl ",), "licen[cs]e epl v?2(?: 0)?", 72, 0.9),
    ("cc0", (" cc0 ",), "licen[cs]e cc0(?: 1 0)?", 72, 0.9),
    ("cc-by-nc-sa", (" cc ",), "licen[cs]e cc by nc sa(?: [1234] 0)?", 74, 0.9),
    ("cc-by-nc-nd", (" cc ",), "licen[cs]e cc by nc nd(?: [1234] 0)?", 74, 0.9),
    ("cc-by-nc", (" cc ",), "licen[cs]e cc by nc(?! (?:sa|nd))(?: [1234] 0)?", 73, 0.9),
    ("cc-by-sa", (" cc ",), "licen[cs]e cc by sa(?: [1234] 0)?", 73, 0.9),
    ("cc-by-nd", (" cc ",), "licen[cs]e cc by nd(?: [1234] 0)?", 73, 0.9),
    ("cc-by", (" cc ",), "licen[cs]e cc by(?! (?:nc|sa|nd))(?: [1234] 0)?", 72, 0.9),
    ("unlicense", ("unlicen",), "licen[cs]e (?:the )?unlicen[cs]e", 72, 0.9),
    ("wtfpl", ("wtfpl",), "licen[cs]e wtfpl", 72, 0.9),
    ("zlib", ("zlib",), "licen[cs]e zlib", 72, 0.9),
    ("boost-1", (" bsl ",), "licen[cs]e bsl 1 0", 72, 0.85),
    ("artistic-2", ("artistic",), "licen[cs]e artistic 2(?: 0)?", 72, 0.85),
    ("postgresql", ("postgresql",), "licen[cs]e postgresql", 72, 0.85),
    ("python-2", (" psf",), "licen[cs]e psf(?: 2 0)?", 72, 0.85),
    ("ofl-1", (" ofl ",), "licen[cs]e ofl(?: 1 [01])?", 72, 0.9),
    ("eupl-1", ("eupl",), "licen[cs]e eupl(?: 1 [012])?", 72, 0.9),
    ("ms-pl", (" ms pl ",), "licen[cs]e ms pl", 72, 0.9),
    ("proprietary", ("propriet",), "licen[cs]e (?:proprietary|commercial proprietary)", 72, 0.8),
    ("unknown", ("licen",), "licen[cs]e (?:unknown|not specified|none given)", 40, 0.3),
    # versions with a letter, and titles with "v"
    ("apache-2", ("apache",), "apache(?: software)? licen[cs]e v2(?: 0)?", 66, 0.9),
    ("apache-1.1", ("apache",), "apache(?: software)? licen[cs]e v1 1", 66, 0.9),
    ("apache-2", ("apache",), "apache v2(?: 0)?", 55, 0.75),
    ("apache-2", ("apachev2",), "apachev2(?: 0)?", 55, 0.75),
    ("apache-2", ("apache2",), "apache2 licen[cs]e", 55, 0.75),
    ("gpl-1", (" gpl ",), "(?:gnu )?gpl v1(?: 0)?", 56, 0.8),
    ("gpl-2", (" gpl ",), "(?:gnu )?gpl v2(?: 0)?", 56, 0.85),
    ("gpl-3", (" gpl ",), "(?:gnu )?gpl v3(?: 0)?", 56, 0.85),
    ("gpl-2", (" gpl ",), "(?:gnu )?gpl version 2", 56, 0.85),
    ("gpl-3", (" gpl ",), "(?:gnu )?gpl version 3", 56, 0.85),
    ("lgpl-2", (" lgpl ",), "(?:gnu )?lgpl v2(?: [01])?", 56, 0.85),
    ("lgpl-3", (" lgpl ",), "(?:gnu )?lgpl v3(?: 0)?", 56, 0.85),
    ("lgpl-2", (" lgpl ",), "(?:gnu )?lgpl version 2(?: [01])?", 56, 0.85),
    ("lgpl-3", (" lgpl ",), "(?:gnu )?lgpl version 3", 56, 0.85),
    ("agpl-3", (" agpl ",), "(?:gnu )?agpl (?:v3(?: 0)?|version 3)", 56, 0.85),
    ("gpl-2", ("general public",), "general public licen[cs]e v2(?: 0)?", 58, 0.85),
    ("gpl-3", ("general public",), "(?<!affero )(?<!lesser )general public licen[cs]e v3(?: 0)?", 58, 0.85),
    ("lgpl-2", ("lesser general",), "lesser general public licen[cs]e v2(?: [01])?", 59, 0.85),
    ("lgpl-3", ("lesser general",), "lesser general public licen[cs]e v3(?: 0)?", 59, 0.85),
    ("agpl-3", ("affero",), "affero general public licen[cs]e(?: v3(?: 0)?)?", 59, 0.85),
    ("mpl-2", ("mozilla",), "mozilla public licen[cs]e v2(?: 0)?", 58, 0.9),
    ("epl-2", ("eclipse",), "eclipse public licen[cs]e v2(?: 0)?", 58, 0.9),
    ("epl-1", ("eclipse",), "eclipse public licen[cs]e v1(?: 0)?", 58, 0.9),
    ("boost-1", ("boost",), "boost licen[cs]e(?: v?1(?: 0)?)?", 50, 0.75),
    # glued forms
    ("gpl-1", ("gplv1",), "gplv1", 55, 0.8),
    ("gpl-2", ("gplv2",), "gplv2(?: 0)?(?: only)?", 55, 0.85),
    ("gpl-3", ("gplv3",), "gplv3(?: 0)?(?: only)?", 55, 0.85),
    ("gpl-2", ("gpl2",), "gpl2", 55, 0.8),
    ("gpl-3", ("gpl3",), "gpl3", 55, 0.8),
    ("lgpl-2", ("lgplv2",), "lgplv2(?: [01])?", 55, 0.85),
    ("lgpl-3", ("lgplv3",), "lgplv3(?: 0)?", 55, 0.85),
    ("lgpl-2", ("lgpl2",), "lgpl2(?: [01])?", 55, 0.8),
    ("lgpl-3", ("lgpl3",), "lgpl3", 55, 0.8),
    ("agpl-3", ("agplv3",), "agplv3(?: 0)?", 55, 0.85),
    ("agpl-3", ("agpl3",), "agpl3", 55, 0.8),
    ("mpl-2", ("mplv2",), "mplv2(?: 0)?", 55, 0.8),
    ("mpl-2", ("mpl2",), "mpl2", 55, 0.75),
    ("cc-by", ("ccby",), "ccby", 52, 0.7),
    ("cc-by-sa", ("ccbysa",), "ccbysa", 52, 0.7),
    # names as identifiers write them, with or without what follows
    ("gpl-2", (" gpl ",), "gpl 2 0 or later", 65, 0.9),
    ("gpl-2", (" gpl ",), "gpl 2 0 only", 65, 0.9),
    ("gpl-3", (" gpl ",), "gpl 3 0 or later", 65, 0.9),
    ("gpl-3", (" gpl ",), "gpl 3 0 only", 65, 0.9),
    ("lgpl-2", (" lgpl ",), "lgpl 2 [01] or later", 65, 0.9),
    ("lgpl-2", (" lgpl ",), "lgpl 2 [01] only", 65, 0.9),
    ("lgpl-3", (" lgpl ",), "lgpl 3 0 or later", 65, 0.9),
    ("lgpl-3", (" lgpl ",), "lgpl 3 0 only", 65, 0.9),
    ("agpl-3", (" agpl ",), "agpl 3 0(?: or later| only)?", 65, 0.9),
    ("gpl-2", (" gpl ",), "gpl 2(?: 0)?", 48, 0.7),
    ("gpl-3", (" gpl ",), "gpl 3(?: 0)?", 48, 0.7),
    ("lgpl-2", (" lgpl ",), "lgpl 2 [01]", 48, 0.75),
    ("lgpl-3", (" lgpl ",), "lgpl 3(?: 0)?", 48, 0.75),
    ("apache-2", ("apache",), "apache 2 0", 48, 0.75),
    ("bsd-2", (" bsd ",), "bsd 2 clause", 52, 0.85),
    ("bsd-3", (" bsd ",), "bsd 3 clause", 52, 0.85),
    ("bsd-4", (" bsd ",), "bsd 4 clause", 52, 0.85),
    ("bsd-2", (" bsd ",), "simplified bsd(?: licen[cs]e)?", 52, 0.8),
    ("bsd-2", (" bsd ",), "freebsd licen[cs]e", 52, 0.8),
    ("bsd-3", (" bsd ",), "(?:new|modified|revised) bsd(?: licen[cs]e)?", 52, 0.8),
    ("mpl-2", (" mpl ",), "mpl 2 0", 52, 0.85),
    ("mpl-1", (" mpl ",), "mpl 1 1", 52, 0.85),
    ("epl-2", (" epl ",), "epl 2 0", 52, 0.85),
    ("epl-1", (" epl ",), "epl 1 0", 52, 0.85),
    ("cc0", (" cc0 ",), "cc0 1 0", 52, 0.85),
    ("cc-by-nc-sa", (" cc ",), "cc by nc sa(?: [1234] 0)?", 54, 0.85),
    ("cc-by-nc-nd", (" cc ",), "cc by nc nd(?: [1234] 0)?", 54, 0.85),
    ("cc-by-nc", (" cc ",), "cc by nc [1234] 0", 53, 0.85),
    ("cc-by-sa", (" cc ",), "cc by sa(?: [1234] 0)?", 53, 0.85),
    ("cc-by-nd", (" cc ",), "cc by nd(?: [1234] 0)?", 53, 0.85),
    ("cc-by", (" cc ",), "cc by [1234] 0", 52, 0.85),
    ("odbl-1", ("odbl",), "odbl(?: 1 0)?", 52, 0.8),
    ("sspl-1", ("sspl",), "sspl(?: 1 0)?", 52, 0.8),
    ("bsl-1.1", ("busl",), "busl 1 1", 52, 0.85),
    ("wtfpl", ("wtfpl",), "wtfpl", 48, 0.7),
    # bare names with a word that says what they are
    ("mit", (" mit ",), "mit licen[cs]ed", 60, 0.85),
    ("mit", (" mit ",), "mit style licen[cs]e", 60, 0.8),
    ("mit", (" mit ",), "mit x11 licen[cs]e", 60, 0.8),
    ("mit", (" expat",), "expat licen[cs]e", 60, 0.8),
    ("mit", (" mit ",), "dual licen[cs]ed (?:under )?(?:the )?mit and gpl", 62, 0.85),
    ("mit", (" mit ",), "licen[cs]ed (?:as|with) mit(?! (?:der|dem|den|einer|einem))", 60, 0.7),
    ("apache", ("apache",), "apache licen[cs]ed", 58, 0.75),
    ("bsd", (" bsd ",), "bsd licen[cs]ed", 60, 0.8),
    ("gpl", (" gpl ",), "(?:terms|conditions) of (?:the )?(?:gnu )?gpl(?! v?[0-9])", 62, 0.85),
    ("lgpl", (" lgpl ",), "(?:terms|conditions) of (?:the )?(?:gnu )?lgpl(?! v?[0-9])", 62, 0.85),
    ("agpl-3", (" agpl ",), "(?:terms|conditions) of (?:the )?(?:gnu )?agpl(?! v?[0-9])", 62, 0.8),
    ("gpl", (" gpl ",), "under (?:the )?(?:gnu )?gpl(?! v?[0-9])", 62, 0.85),
    ("lgpl", (" lgpl ",), "under (?:the )?(?:gnu )?lgpl(?! v?[0-9])", 62, 0.85),
    ("agpl-3", (" agpl ",), "under (?:the )?(?:gnu )?agpl(?! v?[0-9])", 62, 0.8),
    ("gpl", (" gpl ",), "gpl(?:ed)? (?:licen[cs]ed?|software|code|compatible)", 50, 0.7),
    ("gpl", ("gpl",), "(?:gnu )?gpl", 35, 0.5),
    ("lgpl", ("lgpl",), "(?:gnu )?lgpl", 35, 0.5),
    ("agpl-3", ("agpl",), "(?:gnu )?agpl", 35, 0.5),
    ("isc", (" isc ",), "isc licen[cs]ed", 60, 0.8),
    ("public-domain", ("public domain",), "public domain(?: software| work| dedication)", 55, 0.7),
    ("cc0", (" cc0 ",), "cc0(?: universal| licen[cs]ed?| dedication)", 50, 0.75),
    # sentences of the licenses' bodies
    ("mit", ("merge publish",), "to use copy modify merge publish distribute sublicen[cs]e and or sell copies of the software", 90, 0.95),
    ("mit", ("permission notice",), "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", 90, 0.95),
    ("bsd", ("redistributions",), "redistributions of source code must retain the above copyright notice this list of conditions", 90, 0.9),
    ("bsd", ("redistributions",), "redistributions in binary form must reproduce the above copyright notice", 90, 0.9),
    ("bsd-3", ("neither the name",), "neither the name of (?:the )?(?:[a-z0-9]+ ){1,8}nor the names of its contributors may be used to endorse or promote", 92, 0.95),
    ("bsd-4", ("advertising",), "all advertising materials mentioning features or use of this software must display", 92, 0.95),
    ("isc", ("fee",), "with or without fee is hereby granted provided that the above copyright notice", 90, 0.9),
    ("apache-2", ("apache org",), "www apache org licen[cs]es licen[cs]e 2 0", 88, 0.95),
    ("apache-2", ("as is",), "unless required by applicable law or agreed to in writing software distributed under the licen[cs]e is distributed on an as is basis", 88, 0.9),
    ("gpl", ("free software foundation",), "redistribute it and or modify it under the terms of the gnu general public licen[cs]e", 85, 0.9),
    ("lgpl", ("free software foundation",), "redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public licen[cs]e", 86, 0.9),
    ("agpl-3", ("free software foundation",), "redistribute it and or modify it under the terms of the gnu affero general public licen[cs]e", 86, 0.9),
    ("gpl-2", ("version 2",), "as published by the free software foundation (?:either )?version 2", 85, 0.9),
    ("gpl-3", ("version 3",), "as published by the free software foundation (?:either )?version 3", 85, 0.9),
    ("gpl", ("without any warranty",), "without any warranty without even the implied warranty of merchantability", 60, 0.5),
    ("gpl", ("gnu org",), "gnu org licen[cs]es gpl(?: [a-z0-9]+)?", 60, 0.8),
    ("lgpl", ("gnu org",), "gnu org licen[cs]es lgpl(?: [a-z0-9]+)?", 60, 0.8),
    ("agpl-3", ("gnu org",), "gnu org licen[cs]es agpl(?: [a-z0-9]+)?", 60, 0.8),
    ("mpl-2", ("mozilla org",), "subject to the terms of the mozilla public licen[cs]e v(?:ersion)? ?2 0", 88, 0.95),
    ("mpl-2", ("mozilla org",), "mozilla org mpl 2 0", 88, 0.9),
    ("mit", ("opensource org",), "opensource org licen[cs]es mit", 88, 0.9),
    ("bsd-3", ("opensource org",), "opensource org licen[cs]es bsd 3 clause", 88, 0.9),
    ("bsd-2", ("opensource org",), "opensource org licen[cs]es bsd 2 clause", 88, 0.9),
    ("cc-by", ("creativecommons org",), "creativecommons org licen[cs]es by [1234] 0", 88, 0.9),
    ("cc-by-sa", ("creativecommons org",), "creativecommons org licen[cs]es by sa [1234] 0", 88, 0.9),
    ("cc-by-nd", ("creativecommons org",), "creativecommons org licen[cs]es by nd [1234] 0", 88, 0.9),
    ("cc-by-nc", ("creativecommons org",), "creativecommons org licen[cs]es by nc [1234] 0", 88, 0.9),
    ("cc-by-nc-sa", ("creativecommons org",), "creativecommons org licen[cs]es by nc sa [1234] 0", 88, 0.9),
    ("cc-by-nc-nd", ("creativecommons org",), "creativecommons org licen[cs]es by nc nd [1234] 0", 88, 0.9),
    ("cc0", ("creativecommons org",), "creativecommons org publicdomain zero 1 0", 88, 0.9),
    ("zlib", ("altered source",), "altered source versions must be plainly marked as such", 90, 0.9),
    ("boost-1", ("boost",), "boost org licen[cs]e 1 0 txt", 88, 0.9),
    ("unlicense", ("unlicense org",), "unlicen[cs]e org", 70, 0.85),
    ("unlicense", ("compile",), "anyone is free to copy modify publish use compile sell or distribute this software", 90, 0.95),
    ("artistic-2", ("artistic",), "the artistic licen[cs]e 2 0", 70, 0.85),
    ("ofl-1", ("font software",), "this font software is licen[cs]ed under the sil open font licen[cs]e", 90, 0.95),
    ("postgresql", ("postgresql",), "postgresql is released under the postgresql licen[cs]e", 90, 0.9),
    ("elastic-2", ("hosted or managed",), "you may not provide the software to third parties as a hosted or managed service", 90, 0.9),
    ("sspl-1", ("service source code",), "you must make the service source code available", 90, 0.9),
    ("bsl-1.1", ("change date",), "(?:change date|additional use grant) (?:[a-z0-9]+ ){1,12}change licen[cs]e", 80, 0.85),
    ("proprietary", ("confidential",), "proprietary and confidential", 60, 0.7),
    ("proprietary", ("unauthori",), "unauthori[sz]ed copying of this (?:file|software|document)(?: via any medium)? is strictly prohibited", 80, 0.85),
    ("non-commercial", ("commercial",), "(?:not for|no) commercial use", 40, 0.6),
    ("non-commercial", ("commercial",), "personal and non ?commercial use", 40, 0.6),
    # second operands of identifiers' expressions that are everyday words elsewhere
    ("mit", ("spdx", " mit "), "(?:apache 2 0|[al]?gpl [23] [01](?: only| or later)?|bsd [0-9] clause|isc|unlicen[cs]e|zlib|0bsd) (?:or|and) mit", 98, 1.0),
)
