"""Signature rules of licences, over texts of lower-case words with one space between them.

A family has a label, keywords of which every text it can match contains one (with a space before and after it), and
hand-written regexes: how the licence is named in prose, its short identifiers, and words of its address or of sentences
that only it has. Each becomes rules of the forms below, in order of priority.
"""

from __future__ import annotations

from dataclasses import dataclass

V = "(?:v|version )?"

#: (label, keywords, names, identifiers, phrases). A regex starts and ends with a whole word.
FAMILIES = [
    ("0bsd", (" 0 clause ", " zero clause ", " 0bsd ", "free public license"), r"(?:bsd )?(?:0|zero) clause (?:bsd )?(?:license|licence)", r"0bsd", r"free public license 1 0 0"),
    ("afl", ("academic free", " afl "), rf"academic free licen[sc]e(?: {V}[123](?: \d)?)?", r"afl (?:1 [12]|2 [01]|3 0)", r"opensource org licenses afl 3 0"),
    ("agpl-3.0", ("affero", "agpl"), rf"(?:gnu )?affero (?:general public|gpl) licen[sc]e(?: {V}3(?: 0)?)?", r"agpl ?v?3(?: 0)?(?: (?:only|or later))?", r"gnu org licenses agpl(?: 3 0)?"),
    ("apache-1.1", ("apache",), rf"apache software licen[sc]e {V}1 1", r"apache 1 1", r"apache org licenses license 1 1"),
    ("apache-2.0", ("apache",), rf"apache (?:software )?licen[sc]e(?: (?:v|version )?2(?: 0)?)?", r"apache ?2(?: 0)?", r"apache org licenses license 2 0"),
    ("apsl-2.0", ("apple public source", " apsl "), rf"apple public source licen[sc]e(?: {V}[12] [0-2])?", r"apsl 2 0", r"opensource apple com apsl"),
    ("artistic-2.0", ("artistic",), rf"artistic licen[sc]e(?: {V}[12] 0)?", r"artistic 2 0", r"perlfoundation org artistic license 2 0"),
    ("bsd-2-clause", (" bsd ",), r"(?:simplified|freebsd|2 clause|two clause) bsd(?: style)? licen[sc]e|bsd (?:2|two) clause licen[sc]e", r"bsd 2 clause", r"opensource org licenses bsd 2 clause"),
    ("bsd-3-clause", (" bsd ",), r"(?:new|revised|modified|3 clause|three clause) bsd(?: style)? licen[sc]e|bsd (?:3|three) clause licen[sc]e", r"bsd 3 clause", r"opensource org licenses bsd 3 clause"),
    ("bsd-4-clause", (" bsd ",), r"(?:original|4 clause|four clause) bsd(?: style)? licen[sc]e", r"bsd 4 clause", r"bsd license with advertising clause"),
    ("bsd", (" bsd ", "berkeley software"), r"bsd(?: style)? licen[sc]e", r"bsd licensed", r"berkeley software distribution licen[sc]e"),
    ("bsl-1.0", (" boost ", " bsl "), rf"boost software licen[sc]e(?: {V}1(?: 0)?)?", r"bsl 1 0", r"boost org license 1 0"),
    ("busl-1.1", ("business source", " busl ", " bsl11 "), rf"business source licen[sc]e(?: {V}1 [01])?", r"busl 1 1", r"mariadb com bsl11"),
    ("cc0-1.0", ("creative commons", " cc ", " cc0 ", " cczero ", "publicdomain zero"), r"(?:creative commons (?:cc )?(?:zero|0)|cc ?(?:zero|0))(?: (?:v|version )?1 0)?(?: universal)?(?: public domain dedication)?", r"cc0 1 0", r"creativecommons org publicdomain zero 1 0"),
    ("cc-by", ("creative commons", " cc ", "creativecommons"), rf"(?:creative commons|cc) (?:by|attribution)(?: {V}[1-4] [05])?(?: (?:international|unported|generic))?", r"cc by [1-4] [05]", r"creativecommons org licenses by [1-4] [05]"),
    ("cc-by-nc", (" by nc ",), rf"cc by nc(?: {V}[1-4] [05])?(?: (?:international|unported|generic))?", r"cc by nc [1-4] [05]", r"creativecommons org licenses by nc [1-4] [05]"),
    ("cc-by-nc", ("noncommercial",), rf"(?:creative commons )?attribution noncommercial(?: {V}[1-4] [05])?(?: (?:international|unported|generic))?", r"by noncommercial [1-4] [05]", r"for noncommercial purposes only"),
    ("cc-by-nc-nd", (" by nc nd ",), rf"cc by nc nd(?: {V}[1-4] [05])?(?: (?:international|unported|generic))?", r"cc by nc nd [1-4] [05]", r"creativecommons org licenses by nc nd [1-4] [05]"),
    ("cc-by-nc-sa", (" by nc sa ",), rf"cc by nc sa(?: {V}[1-4] [05])?(?: (?:international|unported|generic))?", r"cc by nc sa [1-4] [05]", r"creativecommons org licenses by nc sa [1-4] [05]"),
    ("cc-by-nd", (" by nd ",), rf"cc by nd(?: {V}[1-4] [05])?(?: (?:international|unported|generic))?", r"cc by nd [1-4] [05]", r"creativecommons org licenses by nd [1-4] [05]"),
    ("cc-by-nd", ("noderivatives", "no derivative"), rf"(?:creative commons )?attribution noderivatives(?: {V}[1-4] [05])?", r"by noderivatives [1-4] [05]", r"no derivative works licen[sc]e"),
    ("cc-by-sa", (" by sa ",), rf"cc by sa(?: {V}[1-4] [05])?(?: (?:international|unported|generic))?", r"cc by sa [1-4] [05]", r"creativecommons org licenses by sa [1-4] [05]"),
    ("cc-by-sa", ("sharealike", "share alike"), rf"(?:creative commons )?attribution sharealike(?: {V}[1-4] [05])?(?: (?:international|unported|generic))?", r"by sharealike [1-4] [05]", r"share alike licen[sc]e"),
    ("cddl", ("common development", " cddl "), rf"common development and distribution licen[sc]e(?: {V}1 [01])?", r"cddl 1 [01]", r"opensource org licenses cddl(?: 1 0)?"),
    ("cecill", ("cecill",), rf"cecill(?: (?:b|c))?(?: free software)? licen[sc]e(?: agreement)?(?: {V}[12](?: [01])?)?", r"cecill (?:b|c|2 [01])", r"cecill info licences"),
    ("cpal-1.0", ("public attribution", " cpal "), rf"common public attribution licen[sc]e(?: {V}1 0)?", r"cpal 1 0", r"opensource org licenses cpal 1 0"),
    ("cpl-1.0", ("common public", " cpl "), rf"common public licen[sc]e(?: {V}1 0)?", r"cpl 1 0", r"opensource org licenses cpl 1 0"),
    ("ecl-2.0", ("educational community", " ecl "), rf"educational community licen[sc]e(?: {V}[12] 0)?", r"ecl 2 0", r"opensource org licenses ecl 2 0"),
    ("elastic-2.0", (" elastic ",), rf"elastic licen[sc]e(?: {V}2(?: 0)?)?", r"elastic 2 0", r"elastic co licensing elastic license"),
    ("epl", ("eclipse", " epl "), rf"eclipse public licen[sc]e(?: {V}[12] 0)?", r"epl [12] 0", r"eclipse org legal epl (?:v10|2 0)"),
    ("edl-1.0", ("eclipse", " edl "), rf"eclipse distribution licen[sc]e(?: {V}1 0)?", r"edl 1 0", r"eclipse org org documents edl v10"),
    ("eupl", ("european union public", " eupl "), rf"european union public licen[sc]e(?: {V}1 [012])?", r"eupl 1 [012]", r"joinup ec europa eu (?:software page|collection) eupl"),
    ("fdl", ("free documentation", " gfdl ", " fdl "), rf"(?:gnu )?free documentation licen[sc]e(?: {V}1 [123])?", r"gfdl 1 [123](?: (?:only|or later))?", r"gnu org (?:copyleft|licenses) fdl"),
    ("gpl", (" gpl ", "general public"), r"(?:gnu )?(?:gpl|general public licen[sc]e)", r"gnu gpl", r"gnu org licenses gpl"),
    ("gpl-2.0", (" gpl", "general public"), r"(?:gnu )?(?:gpl|general public licen[sc]e) (?:as published by the free software foundation )?(?:either )?v?(?:ersion )?2(?: 0)?(?: or (?:any )?later(?: version)?)?", r"gpl ?v?2(?: 0)?(?: (?:only|or later))?", r"gnu org licenses (?:old licenses )?gpl 2 0"),
    ("gpl-3.0", (" gpl", "general public"), r"(?:gnu )?(?:gpl|general public licen[sc]e) (?:as published by the free software foundation )?(?:either )?v?(?:ersion )?3(?: 0)?(?: or (?:any )?later(?: version)?)?", r"gpl ?v?3(?: 0)?(?: (?:only|or later))?", r"gnu org licenses gpl 3 0"),
    ("hpnd", ("historical permission", " hpnd "), r"historical permission notice and disclaimer", r"hpnd", r"opensource org licenses hpnd"),
    ("icu", (" icu ", "components for unicode"), r"icu licen[sc]e", r"icu", r"international components for unicode licen[sc]e"),
    ("ijg", ("jpeg group", " ijg "), r"independent jpeg group licen[sc]e", r"ijg", r"based in part on the work of the independent jpeg group"),
    ("isc", (" isc ",), r"isc licen[sc]e", r"isc", r"opensource org licenses isc"),
    ("lgpl", (" lgpl ", "lesser general", "library general"), r"(?:gnu )?(?:lgpl|(?:lesser|library) general public licen[sc]e)", r"gnu lgpl", r"gnu org licenses lgpl"),
    ("lgpl-2.1", (" lgpl", "lesser general"), r"(?:gnu )?(?:lgpl|lesser general public licen[sc]e) v?(?:ersion )?2 1(?: or (?:any )?later(?: version)?)?", r"lgpl ?v?2 1(?: (?:only|or later))?", r"gnu org licenses (?:old licenses )?lgpl 2 1"),
    ("lgpl-3.0", (" lgpl", "lesser general"), r"(?:gnu )?(?:lgpl|lesser general public licen[sc]e) v?(?:ersion )?3(?: 0)?(?: or (?:any )?later(?: version)?)?", r"lgpl ?v?3(?: 0)?(?: (?:only|or later))?", r"gnu org licenses lgpl 3 0"),
    ("libpng", (" png ", " libpng "), r"(?:lib)?png(?: reference library)? licen[sc]e", r"libpng(?: 2 0)?", r"png reference library version"),
    ("lppl", ("latex project", " lppl "), rf"latex project public licen[sc]e(?: {V}1 [0-3](?:a|c)?)?", r"lppl 1 [0-3](?:a|c)?", r"latex project org lppl"),
    ("mit", (" mit ", " expat ", " x11 "), r"(?:mit|expat|x11)(?: style)? licen[sc]e", r"mit", r"opensource org licenses mit(?: license)?"),
    ("mit-0", (" mit no ", " mit 0 "), r"mit no attribution(?: licen[sc]e)?", r"mit 0", r"github com aws mit 0"),
    ("mpl", ("mozilla", " mpl "), rf"mozilla public licen[sc]e(?: {V}[12] [01])?", r"mpl [12] [01]", r"mozilla org mpl(?: [12] [01])?"),
    ("ms-pl", ("microsoft public", " ms pl "), r"microsoft public licen[sc]e", r"ms pl", r"opensource org licenses ms pl"),
    ("ms-rl", ("microsoft reciprocal", " ms rl "), r"microsoft reciprocal licen[sc]e", r"ms rl", r"opensource org licenses ms rl"),
    ("mulan-psl-2.0", ("mulan",), rf"mulan permissive software licen[sc]e(?: {V}[12])?", r"mulanpsl 2 0", r"license coscl org cn mulanpsl2"),
    ("ncsa", (" ncsa ",), r"(?:university of illinois )?ncsa(?: open source)? licen[sc]e", r"ncsa", r"opensource org licenses ncsa"),
    ("npl", ("netscape public", " npl "), rf"netscape public licen[sc]e(?: {V}1 [01])?", r"npl 1 [01]", r"mozilla org npl"),
    ("odbl-1.0", ("open database", " odbl "), rf"open (?:data commons open )?database licen[sc]e(?: {V}1 0)?", r"odbl 1 0", r"opendatacommons org licenses odbl"),
    ("odc-by", ("open data commons", " odc by ", "opendatacommons"), rf"open data commons attribution licen[sc]e(?: {V}1 0)?", r"odc by 1 0", r"opendatacommons org licenses by"),
    ("ofl-1.1", ("open font", " ofl "), rf"(?:sil )?open font licen[sc]e(?: {V}1 [01])?", r"ofl 1 [01]", r"scripts sil org ofl"),
    ("ogl-3.0", ("open government", " ogl "), rf"open government licen[sc]e(?: {V}[123](?: 0)?)?", r"ogl uk [123] 0", r"nationalarchives gov uk doc open government licence"),
    ("openssl", (" openssl ",), r"openssl(?: and ssleay)? licen[sc]e", r"openssl", r"openssl org source license"),
    ("osl-3.0", ("open software", " osl "), rf"open software licen[sc]e(?: {V}[123](?: \d)?)?", r"osl (?:1 0|2 [01]|3 0)", r"opensource org licenses osl 3 0"),
    ("php", (" php ",), rf"php licen[sc]e(?: {V}3 0?1?)?", r"php 3 0?1?", r"php net license"),
    ("postgresql", (" postgresql ",), r"postgresql licen[sc]e", r"postgresql", r"postgresql org about licence"),
    ("proprietary", ("proprietary", "unauthorized copying"), r"proprietary licen[sc]e(?: agreement)?", r"proprietary and confidential", r"unauthorized copying of this file(?: via any medium)? is strictly prohibited"),
    ("psf-2.0", ("python software", " psf ", " python 2 0 ", "docs python"), rf"python software foundation licen[sc]e(?: {V}2)?", r"psf 2 0|python 2 0", r"docs python org 3 license"),
    ("public-domain", ("public domain",), r"(?:released|placed|dedicated) (?:in|into|to) the public domain|public domain dedication", r"public domain licen[sc]e", r"this work is in the public domain"),
    ("qpl-1.0", (" q public ", " qpl "), rf"q public licen[sc]e(?: {V}1 0)?", r"qpl 1 0", r"opensource org licenses qpl 1 0"),
    ("rpl-1.5", ("reciprocal public", " rpl "), rf"reciprocal public licen[sc]e(?: {V}1 [15])?", r"rpl 1 [15]", r"opensource org licenses rpl 1 5"),
    ("ruby", (" ruby ",), r"ruby licen[sc]e", r"ruby", r"ruby lang org en about license txt"),
    ("sleepycat", ("sleepycat",), r"sleepycat(?: public)? licen[sc]e", r"sleepycat", r"opensource org licenses sleepycat"),
    ("sspl-1.0", ("server side public", " sspl "), rf"server side public licen[sc]e(?: {V}1(?: 0)?)?", r"sspl 1 0", r"mongodb com licensing server side public license"),
    ("unicode", (" unicode ",), r"unicode(?: inc)? licen[sc]e(?: agreement)?(?: data files and software)?", r"unicode dfs 201[56]|unicode 3 0", r"unicode org copyright html"),
    ("unlicense", ("unlicense",), r"(?:the )?unlicense", r"unlicense", r"unlicense org"),
    ("upl-1.0", ("universal permissive", " upl "), rf"universal permissive licen[sc]e(?: {V}1 0)?", r"upl 1 0", r"oss oracle com licenses upl"),
    ("vim", (" vim ", " vimhelp "), r"vim licen[sc]e", r"vim", r"vimhelp org uganda"),
    ("w3c", (" w3c ", " w3 org "), r"w3c(?: software)?(?: notice and)?(?: document)? licen[sc]e", r"w3c", r"w3 org consortium legal copyright software"),
    ("wtfpl", ("do what the", " wtfpl "), rf"do what the f[a-z]* you want to public licen[sc]e(?: {V}2)?", r"wtfpl", r"sam zoy org wtfpl"),
    ("zlib", (" zlib ",), r"zlib(?: libpng)? licen[sc]e", r"zlib", r"opensource org licenses zlib"),
    ("zpl", (" zope ", " zpl "), rf"zope public licen[sc]e(?: {V}[12] [01])?", r"zpl [12] [01]", r"zope org resources zpl"),
    ("all-rights-reserved", ("rights reserved", "rights are reserved", "no part of this"), r"all rights (?:are )?reserved", r"rights reserved worldwide", r"no part of this (?:publication|work|document) may be reproduced"),
    ("copyright-notice", ("copyright",), r"copyright (?:c )?(?:19|20)\d\d(?: (?:19|20)\d\d(?= ))*+", r"copyright c", r"copyright notice and this permission notice"),
]

# Runs are possessive: Java's regexes then repeat a group in a loop, else they call themselves once per round, and a long run would
# end the stack. No name has to begin with a word that the run takes.
GRANT = r"(?:licensed|licenced|released|distributed|redistributed|published|provided|available|covered|offered|shared|reuse) (?:under|by|according to|subject to|in accordance with)(?: (?:the|a|an|terms|and|conditions|of|gnu|either)(?= ))*+"


#: Every text that a rule of a tag, a grant or an identifier matches contains one of these.
ANCHORS = ("licen", "released ", "distributed ", "published ", "provided ", "available ", "covered ", "offered ", "shared ", "reuse ")


@dataclass(frozen=True)
class Rule:
    priority: int  # the smaller one decides
    confidence: float
    pattern: str
    anchors: tuple[str, ...] = ()  # every text it matches contains one, if there are any


def _bounded(pattern: str) -> str:
    return rf"(?<= )(?:{pattern})(?= )"


def family_rules(names: str, identifiers: str, phrases: str) -> list[Rule]:
    """The five forms: tag, grant, own phrase or address, name, identifier next to a word of licensing."""
    return [
        Rule(1, 1.0, _bounded(rf"spdx licen[sc]e identifier (?:{identifiers})"), ("spdx licen",)),
        Rule(2, 0.95, _bounded(rf"{GRANT} (?:{names}|{identifiers})(?: licen[sc]e)?"), ANCHORS),
        Rule(3, 0.9, _bounded(phrases)),
        Rule(4, 0.8, _bounded(names)),
        Rule(5, 0.6, _bounded(rf"(?:licen[sc]e|licensed|licensing)(?: is| type| name)? (?:{identifiers})|(?:{identifiers}) licen[sc]e[ds]?"), ("licen",)),
    ]


def families() -> list[dict]:
    """Families in order, each with its keywords and rules; more rules than families five times over."""
    return [
        {"label": label, "keywords": keywords, "rules": [vars(r) for r in family_rules(*regexes)]}
        for label, keywords, *regexes in FAMILIES
    ]
