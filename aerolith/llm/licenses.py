"""License scans: ordered signature rules over whole texts. Built of DataFrame functions only.

A rule is a regular expression with keywords, a priority (0 is the strongest), a label and a confidence. The keyword prefilter works on words: the keywords
that stand among a text's words are found by one set intersection, and only rules one of whose keywords is among them are run. Each rule's keyword is a single word that its
matches hold, so that line breaks inside a phrase hide nothing. The rules are a literal array in the plan. All places of a
rule are found by splitting the text at its matches. Detections are then put in order (start, longest first, priority,
rule) and run through once: one that lies within an earlier one of equal or better priority is suppressed, so that
"GNU General Public License" inside "licensed under the GNU General Public License, version 3" is not reported beside it, while a strong
detection inside a weaker one stays, as does the weaker one.

Rules are of two sorts: the wording of grants, notices, conditions and disclaimers, each written by hand (TEXTS); and the names of license families (FAMILIES), with their SPDX lines, their
addresses, and the phrases that grant or mention a license by its name.

Beside the rules three base phrases are looked for word by word: their words must stand consecutively, whatever
characters part them.

Scale: one narrow pass; nothing is shuffled, broadcast or collected. Texts without a keyword, nearly all, cost a split into
words and that intersection. Work grows with the text, and with the detections of one text.

Defined cases: a null or empty text has no words, no labels and score 0. Very long texts are read whole. Ties: of detections with equal places
and priority the rule that stands first stays. Repeated rows are scanned alike. Other columns are left alone. An empty table gives an
empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_of
from .quality import let


@dataclass(frozen=True)
class Rule:
    priority: int
    label: str
    keywords: tuple[str, ...]
    regex: str
    confidence: float


#: Label, keywords, name as a regex over lower-cased text (a space stands for any white space), SPDX identifier as a regex, canonical URL as a regex ("" if none).
FAMILIES = [
    ("mit", ("mit",), r"mit(?: x11| expat)?", r"mit(?:-0)?", r"opensource\.org/licenses/mit(?:\.php)?"),
    ("apache-2.0", ("apache", "apache2",), r"apache(?: software)?(?: license)?(?:,? (?:version|v\.?) ?|[ -]v?)2(?:\.0)?", r"apache-2\.0", r"apache\.org/licenses/license-2\.0"),
    ("apache-2.0", ("apache", "apache2",), r"apache license,? version 2\.0", r"apache2", r"opensource\.org/licenses/apache-2\.0"),
    ("apache-1.1", ("apache", "apache2",), r"apache(?: software)?(?: license)?,? (?:version |v)?1\.1", r"apache-1\.1", r"apache\.org/licenses/license-1\.1"),
    ("bsd-2-clause", ("bsd", "freebsd",), r"(?:bsd[ -]2[ -]clause|simplified bsd|freebsd|2[ -]clause bsd)", r"bsd-2-clause", r"opensource\.org/licenses/bsd-2-clause"),
    ("bsd-3-clause", ("bsd", "freebsd",), r"(?:bsd[ -]3[ -]clause|(?:new|modified|revised) bsd|3[ -]clause bsd)", r"bsd-3-clause", r"opensource\.org/licenses/bsd-3-clause"),
    ("bsd-4-clause", ("bsd", "freebsd",), r"(?:original bsd|bsd[ -]4[ -]clause|4[ -]clause bsd)", r"bsd-4-clause", ""),
    ("gpl-1.0", ("general",), r"(?:gnu )?general public license,? (?:version |v)1(?:\.0)?", r"gpl-1\.0(?:-only|-or-later|\+)?", r"gnu\.org/licenses/(?:old-licenses/)?gpl-1\.0"),
    ("gpl-2.0", ("general",), r"(?:gnu )?general public license,? (?:version |v)2(?:\.0)?", r"gpl-2\.0(?:-only|-or-later|\+)?", r"gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0"),
    ("gpl-3.0", ("general",), r"(?:gnu )?general public license,? (?:version |v)3(?:\.0)?", r"gpl-3\.0(?:-only|-or-later|\+)?", r"gnu\.org/licenses/gpl-3\.0"),
    ("gpl-2.0", ("gpl", "gplv2", "gplv3", "gpl2", "gpl3",), r"(?:gnu )?gpl ?v?2(?:\.0)?\+?", r"gplv2", r"opensource\.org/licenses/gpl-2\.0"),
    ("gpl-3.0", ("gpl", "gplv2", "gplv3", "gpl2", "gpl3",), r"(?:gnu )?gpl ?v?3(?:\.0)?\+?", r"gplv3", r"opensource\.org/licenses/gpl-3\.0"),
    ("gpl", ("general",), r"(?:gnu )?general public", r"gpl", r"gnu\.org/licenses/gpl\.html"),
    ("gpl", ("gpl", "gplv2", "gplv3", "gpl2", "gpl3",), r"(?:gnu )?gpl", r"gnu gpl", r"gnu\.org/copyleft/gpl"),
    ("lgpl-2.1", ("lesser",), r"(?:gnu )?lesser general public license,? (?:version |v)2\.1", r"lgpl-2\.1(?:-only|-or-later|\+)?", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1"),
    ("lgpl-3.0", ("lesser",), r"(?:gnu )?lesser general public license,? (?:version |v)3(?:\.0)?", r"lgpl-3\.0(?:-only|-or-later|\+)?", r"gnu\.org/licenses/lgpl-3\.0"),
    ("lgpl", ("lesser",), r"(?:gnu )?lesser general public", r"lgpl", r"gnu\.org/licenses/lgpl\.html"),
    ("lgpl", ("library",), r"(?:gnu )?library general public", r"lgpl-2\.0(?:-only|-or-later|\+)?", r"gnu\.org/copyleft/lesser"),
    ("agpl-3.0", ("affero",), r"(?:gnu )?affero general public(?: license,? (?:version |v)3(?:\.0)?)?", r"agpl-3\.0(?:-only|-or-later|\+)?", r"gnu\.org/licenses/agpl(?:-3\.0)?"),
    ("gfdl", ("documentation",), r"(?:gnu )?free documentation", r"gfdl-1\.[123](?:-only|-or-later)?", r"gnu\.org/licenses/fdl"),
    ("mpl-1.1", ("mozilla",), r"mozilla public license,? (?:version |v)?1\.1", r"mpl-1\.1", r"mozilla\.org/mpl/1\.1"),
    ("mpl-2.0", ("mozilla",), r"mozilla public license,? (?:version |v)?2\.0", r"mpl-2\.0", r"mozilla\.org/(?:en-us/)?mpl/2\.0"),
    ("mpl", ("mozilla",), r"mozilla public", r"mpl", r"mozilla\.org/mpl"),
    ("epl-1.0", ("eclipse",), r"eclipse public license,?(?: -)? (?:version |v)?1\.0", r"epl-1\.0", r"eclipse\.org/legal/epl-v10"),
    ("epl-2.0", ("eclipse",), r"eclipse public license,?(?: -)? (?:version |v)?2\.0", r"epl-2\.0", r"eclipse\.org/legal/epl-2\.0"),
    ("cddl", ("cddl", "development",), r"common development and distribution", r"cddl-1\.[01]", r"opensource\.org/licenses/cddl-1\.0"),
    ("cc0", ("cc0",), r"cc0(?: 1\.0)?(?: universal)?", r"cc0-1\.0", r"creativecommons\.org/publicdomain/zero/1\.0"),
    ("cc-by-nc-nd", ("cc",), r"cc[ -]by-nc-nd(?:[ -][234]\.[05])?", r"cc-by-nc-nd-[234]\.[05]", r"creativecommons\.org/licenses/by-nc-nd/[234]\.[05]"),
    ("cc-by-nc-sa", ("cc",), r"cc[ -]by-nc-sa(?:[ -][234]\.[05])?", r"cc-by-nc-sa-[234]\.[05]", r"creativecommons\.org/licenses/by-nc-sa/[234]\.[05]"),
    ("cc-by-nc", ("cc",), r"cc[ -]by-nc(?:[ -][234]\.[05])?(?![a-z-])", r"cc-by-nc-[234]\.[05]", r"creativecommons\.org/licenses/by-nc/[234]\.[05]"),
    ("cc-by-nd", ("cc",), r"cc[ -]by-nd(?:[ -][234]\.[05])?", r"cc-by-nd-[234]\.[05]", r"creativecommons\.org/licenses/by-nd/[234]\.[05]"),
    ("cc-by-sa", ("cc",), r"cc[ -]by-sa(?:[ -][234]\.[05])?", r"cc-by-sa-[234]\.[05]", r"creativecommons\.org/licenses/by-sa/[234]\.[05]"),
    ("cc-by", ("cc",), r"cc[ -]by(?:[ -][234]\.[05])?(?![a-z-])", r"cc-by-[234]\.[05]", r"creativecommons\.org/licenses/by/[234]\.[05]"),
    ("cc-by-sa", ("commons",), r"creative commons attribution[ -]share ?alike(?: [234]\.[05])?(?: international| unported)?", r"cc by-sa", ""),
    ("cc-by-nc", ("commons",), r"creative commons attribution[ -]non-?commercial(?: [234]\.[05])?(?: international| unported)?", r"cc by-nc", ""),
    ("cc-by", ("commons",), r"creative commons attribution(?: [234]\.[05])?(?: international| unported)?", r"cc by", ""),
    ("isc", ("isc",), r"isc", r"isc", r"opensource\.org/licenses/isc"),
    ("unlicense", ("unlicense",), r"(?:the )?unlicense", r"unlicense", r"unlicense\.org"),
    ("zlib", ("zlib",), r"zlib(?:/libpng)?", r"zlib", r"opensource\.org/licenses/zlib"),
    ("artistic-2.0", ("artistic",), r"artistic license,? (?:version )?2\.0", r"artistic-2\.0", r"opensource\.org/licenses/artistic-2\.0"),
    ("artistic", ("artistic",), r"(?:clarified )?artistic", r"artistic-1\.0(?:-perl|-cl8)?", ""),
    ("boost-1.0", ("boost",), r"boost software(?: license,? version 1\.0)?", r"bsl-1\.0", r"boost\.org/license_1_0"),
    ("wtfpl", ("wtfpl",), r"wtfpl", r"wtfpl", r"wtfpl\.net"),
    ("odbl", ("database",), r"open database", r"odbl-1\.0", r"opendatacommons\.org/licenses/odbl"),
    ("pddl", ("dedication",), r"public domain dedication and", r"pddl-1\.0", r"opendatacommons\.org/licenses/pddl"),
    ("python-2.0", ("python",), r"python software foundation", r"(?:python|psf)-2\.0", r"docs\.python\.org/\d/license"),
    ("ofl-1.1", ("font",), r"(?:sil )?open font", r"ofl-1\.1", r"scripts\.sil\.org/ofl"),
    ("eupl-1.2", ("european",), r"european union public licen[cs]e,? v(?:\.|ersion)? ?1\.2", r"eupl-1\.2", r"joinup\.ec\.europa\.eu/.{0,40}eupl"),
    ("ms-pl", ("microsoft",), r"microsoft public", r"ms-pl", r"opensource\.org/licenses/ms-pl"),
    ("postgresql", ("postgresql",), r"postgresql", r"postgresql", r"opensource\.org/licenses/postgresql"),
]
_GRANT = r"(?:licen[sc]ed|released|distributed|available|published|provided|shared|covered|redistribute it(?: and/or modify it)?)\s+under\s+(?:the\s+)?(?:terms\s+of\s+(?:the\s+)?)?"
#: Rules that no family has, each written by hand: priority, label, keywords, regex over lower-cased text, confidence.
TEXTS = [
    # grants and conditions in the words of the license itself
    Rule(1, "mit", ("hereby",), r"permission\s+is\s+hereby\s+granted,?\s+free\s+of\s+charge,?\s+to\s+any\s+person\s+obtaining\s+a\s+copy\s+of\s+this\s+software", 0.97),
    Rule(1, "mit", ("hereby",), r"permission\s+is\s+hereby\s+granted,?\s+free\s+of\s+charge", 0.95),
    Rule(1, "mit", ("permission",), r"the\s+above\s+copyright\s+notice\s+and\s+this\s+permission\s+notice\s+shall\s+be\s+included\s+in\s+all\s+copies", 0.95),
    Rule(2, "mit", ("sublicense",), r"to\s+use,\s+copy,\s+modify,\s+merge,\s+publish,\s+distribute,\s+sublicense,?\s+and/or\s+sell", 0.9),
    Rule(1, "boost-1.0", ("hereby",), r"permission\s+is\s+hereby\s+granted,?\s+free\s+of\s+charge,?\s+to\s+any\s+person\s+or\s+organization\s+obtaining\s+a\s+copy", 0.97),
    Rule(1, "isc", ("permission",), r"permission\s+to\s+use,\s+copy,\s+modify,\s+and(?:/or)?\s+distribute\s+this\s+software\s+for\s+any\s+purpose", 0.95),
    Rule(1, "isc", ("permission",), r"permission\s+to\s+use,\s+copy,\s+modify,\s+and(?:/or)?\s+distribute", 0.9),
    Rule(2, "isc", ("disclaims",), r"the\s+author\s+disclaims\s+all\s+warranties\s+with\s+regard\s+to\s+this\s+software", 0.85),
    Rule(1, "bsd", ("redistribution", "redistributions"), r"redistributions?\s+and\s+use\s+in\s+source\s+and\s+binary\s+forms", 0.95),
    Rule(1, "bsd", ("redistributions",), r"redistributions\s+of\s+source\s+code\s+must\s+retain\s+the\s+above\s+copyright\s+notice", 0.95),
    Rule(1, "bsd", ("redistributions",), r"redistributions\s+in\s+binary\s+form\s+must\s+reproduce\s+the\s+above\s+copyright\s+notice", 0.95),
    Rule(1, "bsd-3-clause", ("endorse",), r"(?:neither\s+the\s+name\s+of|the\s+names?\s+of).{1,120}?may\s+(?:not\s+)?be\s+used\s+to\s+endorse\s+or\s+promote\s+products", 0.93),
    Rule(1, "bsd-4-clause", ("advertising",), r"all\s+advertising\s+materials\s+mentioning\s+features\s+or\s+use\s+of\s+this\s+software", 0.97),
    Rule(1, "apache-2.0", ("compliance",), r"you\s+may\s+not\s+use\s+this\s+(?:file|work|software)\s+except\s+in\s+compliance\s+with\s+the\s+license", 0.95),
    Rule(1, "apache-2.0", ("asf",), r"licensed\s+to\s+the\s+apache\s+software\s+foundation\s+\(asf\)\s+under\s+one\s+or\s+more", 0.97),
    Rule(2, "apache-2.0", ("governing",), r"see\s+the\s+license\s+for\s+the\s+specific\s+language\s+governing\s+permissions", 0.85),
    Rule(1, "apache-2.0", ("perpetual",), r"hereby\s+grants\s+to\s+you\s+a\s+perpetual,\s+worldwide,\s+non-exclusive,\s+no-charge,\s+royalty-free,\s+irrevocable", 0.93),
    Rule(1, "gpl", ("redistribute",), r"this\s+(?:program|file|library|software)\s+is\s+free\s+software[:;,]?\s+you\s+can\s+redistribute\s+it\s+and/or\s+modify", 0.93),
    Rule(2, "gpl", ("merchantability",), r"without\s+any\s+warranty;?\s+without\s+even\s+the\s+implied\s+warranty\s+of\s+merchantability", 0.85),
    Rule(2, "gpl", ("received",), r"you\s+should\s+have\s+received\s+a\s+copy\s+of\s+the\s+gnu\s+(?:lesser\s+|affero\s+|library\s+)?general\s+public\s+license", 0.93),
    Rule(1, "gpl", ("verbatim",), r"everyone\s+is\s+permitted\s+to\s+copy\s+and\s+distribute\s+verbatim\s+copies\s+of\s+this\s+license", 0.9),
    Rule(2, "gpl-2.0", ("gpl", "gplv2"), r"(?:dual[- ])?licensed\s+under\s+(?:the\s+)?gpl,?\s*(?:v|version\s+)2(?:\s+only)?", 0.93),
    Rule(2, "gpl-3.0", ("gpl", "gplv3"), r"(?:dual[- ])?licensed\s+under\s+(?:the\s+)?gpl,?\s*(?:v|version\s+)3(?:\s+or\s+later)?", 0.93),
    Rule(2, "gpl", ("later",), r"either\s+version\s+[123](?:\.\d)?\s+of\s+the\s+license,\s+or\s+\(at\s+your\s+option\)\s+any\s+later\s+version", 0.9),
    Rule(1, "agpl-3.0", ("remotely",), r"interacting\s+with\s+it\s+remotely\s+through\s+a\s+computer\s+network", 0.9),
    Rule(1, "lgpl", ("library",), r"work\s+that\s+uses\s+the\s+library", 0.75),
    Rule(1, "gfdl", ("invariant",), r"with\s+no\s+invariant\s+sections,\s+no\s+front-cover\s+texts,?\s+and\s+no\s+back-cover\s+texts", 0.97),
    Rule(1, "mpl-2.0", ("mozilla",), r"this\s+source\s+code\s+form\s+is\s+subject\s+to\s+the\s+terms\s+of\s+the\s+mozilla\s+public\s+license,\s+v\.\s+2\.0", 0.98),
    Rule(1, "mpl-1.1", ("mozilla",), r"the\s+contents\s+of\s+this\s+file\s+are\s+subject\s+to\s+the\s+mozilla\s+public\s+license", 0.95),
    Rule(1, "mpl-2.0", ("secondary",), r"incompatible\s+with\s+secondary\s+licenses", 0.85),
    Rule(1, "epl", ("accompanying",), r"this\s+program\s+and\s+the\s+accompanying\s+materials\s+are\s+made\s+available\s+under\s+the\s+terms\s+of\s+the\s+eclipse", 0.95),
    Rule(1, "cddl", ("cddl",), r"cddl\s+header\s+(?:start|end)", 0.97),
    Rule(1, "cddl", ("development",), r"subject\s+to\s+the\s+terms\s+of\s+the\s+common\s+development\s+and\s+distribution\s+license", 0.95),
    Rule(1, "zlib", ("altered",), r"altered\s+source\s+versions\s+must\s+be\s+plainly\s+marked\s+as\s+such", 0.95),
    Rule(1, "zlib", ("misrepresented",), r"the\s+origin\s+of\s+this\s+software\s+must\s+not\s+be\s+misrepresented", 0.95),
    Rule(2, "zlib", ("provided",), r"this\s+software\s+is\s+provided\s+'as-is',\s+without\s+any\s+express\s+or\s+implied\s+warranty", 0.85),
    Rule(1, "artistic", ("perl",), r"under\s+the\s+same\s+terms\s+as\s+perl(?:\s+itself)?", 0.9),
    Rule(1, "unlicense", ("unencumbered",), r"this\s+is\s+free\s+and\s+unencumbered\s+software\s+released\s+into\s+the\s+public\s+domain", 0.98),
    Rule(1, "unlicense", ("jurisdictions",), r"in\s+jurisdictions\s+that\s+recognize\s+copyright\s+laws,\s+the\s+author", 0.85),
    Rule(1, "wtfpl", ("want",), r"do\s+what\s+the\s+f\*?u?\*?ck\s+you\s+want\s+to(?:\s+public\s+license)?", 0.95),
    Rule(1, "cc0", ("waived",), r"to\s+the\s+extent\s+possible\s+under\s+law,.{1,160}?\s+waived\s+all\s+copyright", 0.95),
    Rule(1, "cc0", ("dedicated",), r"dedicated\s+the\s+work\s+to\s+the\s+public\s+domain\s+by\s+waiving", 0.93),
    Rule(1, "cc", ("commons",), r"this\s+(?:work|article|book|image|file|document)\s+is\s+licen[sc]ed\s+under\s+a\s+creative\s+commons", 0.9),
    Rule(2, "cc", ("commons",), r"available\s+under\s+(?:a|the)\s+creative\s+commons\s+licen[sc]e", 0.85),
    Rule(1, "cc-by", ("attribution",), r"distributed\s+under\s+the\s+terms\s+of\s+the\s+creative\s+commons\s+attribution\s+licen[sc]e", 0.95),
    Rule(1, "cc-by", ("unrestricted",), r"unrestricted\s+use,\s+distribution,\s+and\s+reproduction\s+in\s+any\s+medium,\s+provided\s+the\s+original\s+(?:work|author)", 0.9),
    Rule(1, "cc-by-sa", ("sharealike", "share"), r"text\s+is\s+available\s+under\s+the\s+creative\s+commons\s+attribution-?\s?share-?\s?alike", 0.95),
    Rule(1, "cc-by-nc", ("noncommercial", "commercial"), r"permits\s+(?:any\s+)?non-?\s?commercial\s+(?:use|re-use|reuse),?\s+(?:distribution|sharing)", 0.85),
    Rule(1, "ofl-1.1", ("font",), r"this\s+font\s+software\s+is\s+licensed\s+under\s+the\s+sil\s+open\s+font\s+license", 0.98),
    Rule(1, "ofl-1.1", ("reserved",), r"with\s+reserved\s+font\s+names?", 0.9),
    Rule(1, "odbl", ("database",), r"this\s+.{1,60}?\s+is\s+made\s+available\s+under\s+the\s+open\s+database\s+license", 0.95),
    Rule(1, "postgresql", ("agreement",), r"permission\s+to\s+use,\s+copy,\s+modify,\s+and\s+distribute\s+this\s+software\s+and\s+its\s+documentation\s+for\s+any\s+purpose,\s+without\s+fee,\s+and\s+without\s+a\s+written\s+agreement", 0.97),
    Rule(1, "python-2.0", ("psf",), r"psf\s+license\s+agreement\s+for\s+python", 0.95),
    Rule(1, "beerware", ("beer", "beerware"), r"(?:the\s+)?\"?beer-?ware\s+license\"?|buy\s+me\s+a\s+beer\s+in\s+return", 0.93),
    Rule(1, "json", ("evil",), r"the\s+software\s+shall\s+be\s+used\s+for\s+good,\s+not\s+evil", 0.98),
    Rule(1, "x11", ("consortium",), r"the\s+name\s+of\s+the\s+x\s+consortium\s+shall\s+not\s+be\s+used", 0.95),
    Rule(1, "openssl", ("openssl",), r"this\s+product\s+includes\s+software\s+developed\s+by\s+the\s+openssl\s+project", 0.93),
    Rule(1, "php", ("php",), r"this\s+product\s+includes\s+php\s+software", 0.93),
    Rule(1, "w3c", ("w3c",), r"w3c\s+(?:software|document)\s+(?:notice\s+and\s+)?licen[sc]e", 0.93),
    Rule(1, "unicode", ("unicode",), r"unicode,?\s+inc\.?\s+licen[sc]e\s+agreement", 0.93),
    Rule(1, "ogl-uk", ("government",), r"contains\s+public\s+sector\s+information\s+licensed\s+under\s+the\s+open\s+government\s+licence", 0.95),
    Rule(2, "ogl-uk", ("government",), r"open\s+government\s+licen[sc]e(?:\s+v?\d\.\d)?", 0.85),
    Rule(1, "bsl-1.1", ("business",), r"business\s+source\s+license(?:\s+1\.1)?", 0.9),
    Rule(1, "sspl", ("side",), r"server\s+side\s+public\s+license", 0.93),
    Rule(1, "elastic-2.0", ("elastic",), r"elastic\s+license(?:\s+2\.0)?", 0.85),
    Rule(1, "commons-clause", ("clause",), r"commons\s+clause\"?\s+license\s+condition", 0.93),
    Rule(1, "openrail", ("openrail", "rail"), r"(?:creativeml\s+|bigscience\s+)?open\s?rail(?:[+-]{1,2}m)?\s+licen[sc]e", 0.9),
    # dual licenses, exceptions, terms
    Rule(2, "dual", ("dual", "dually"), r"(?:dual|dually)[- ]licen[sc]ed\s+under", 0.7),
    Rule(2, "exception", ("exception",), r"as\s+a\s+special\s+exception,", 0.6),
    Rule(2, "terms", ("terms",), r"use\s+of\s+this\s+(?:site|service|website)\s+is\s+subject\s+to\s+(?:our|the)\s+terms", 0.6),
    Rule(2, "terms", ("constitutes",), r"use\s+of\s+this\s+(?:site|service|website)\s+constitutes\s+acceptance", 0.6),
    # rights kept
    Rule(1, "reserved", ("reserved",), r"all\s+rights\s+reserved", 0.9),
    Rule(2, "reserved", ("reserved",), r"(?:some|no)\s+rights\s+reserved", 0.7),
    Rule(1, "reserved", ("reservados",), r"(?:todos\s+los|reservados\s+todos\s+los)\s+derechos(?:\s+reservados)?", 0.9),
    Rule(1, "reserved", ("droits",), r"tous\s+droits\s+r[ée]serv[ée]s", 0.9),
    Rule(1, "reserved", ("rechte",), r"alle\s+rechte\s+vorbehalten", 0.9),
    Rule(1, "proprietary", ("proprietary",), r"proprietary\s+and\s+confidential", 0.9),
    Rule(2, "proprietary", ("confidential",), r"(?:strictly|company)\s+confidential", 0.7),
    Rule(1, "proprietary", ("unauthorized", "unauthorised"), r"unauthori[sz]ed\s+(?:copying|use|reproduction|distribution|duplication)", 0.85),
    Rule(2, "proprietary", ("reproduced", "copied", "redistributed"), r"(?:may|must)\s+not\s+be\s+(?:reproduced|copied|redistributed)", 0.75),
    Rule(2, "proprietary", ("reproduced",), r"no\s+part\s+of\s+this\s+(?:publication|book|work|document)\s+may\s+be\s+reproduced", 0.85),
    Rule(2, "proprietary", ("written",), r"without\s+(?:the\s+)?(?:prior|express)\s+written\s+(?:permission|consent)", 0.7),
    Rule(2, "proprietary", ("trade",), r"contains\s+trade\s+secrets", 0.75),
    Rule(2, "proprietary", ("evaluation",), r"for\s+evaluation\s+purposes\s+only", 0.65),
    Rule(2, "non-commercial", ("commercial",), r"(?:for\s+)?non-?\s?commercial\s+(?:use|purposes)\s+only", 0.8),
    Rule(2, "non-commercial", ("personal",), r"for\s+personal,?\s+(?:and\s+)?non-?commercial\s+use", 0.8),
    Rule(2, "non-commercial", ("research", "academic", "educational"), r"for\s+(?:research|academic|educational)\s+(?:use|purposes)\s+only", 0.75),
    # no rights kept
    Rule(1, "public-domain", ("domain",), r"(?:released|dedicated|placed|given)\s+(?:in)?to\s+the\s+public\s+domain", 0.95),
    Rule(2, "public-domain", ("domain",), r"(?:is|are)\s+in\s+the\s+public\s+domain", 0.85),
    Rule(2, "public-domain", ("government",), r"(?:work|works)\s+of\s+the\s+(?:u\.s\.|us|united\s+states)\s+government", 0.8),
    Rule(2, "public-domain", ("copyright",), r"no\s+copyright\s+(?:is\s+claimed|protection|restrictions)", 0.75),
    # disclaimers that many licenses share
    Rule(3, "disclaimer", ("kind",), r"provided\s+\"?as\s+is\"?,?\s+without\s+warranty\s+of\s+any\s+kind", 0.5),
    Rule(3, "disclaimer", ("event",), r"in\s+no\s+event\s+shall\s+the\s+(?:authors?|copyright\s+holders?|contributors)", 0.5),
    Rule(3, "disclaimer", ("disclaimed",), r"any\s+express\s+or\s+implied\s+warranties.{1,160}?are\s+disclaimed", 0.5),
    # notices
    Rule(3, "copyright", ("copyright",), r"copyright\s+(?:\(c\)\s+|©\s+)?(?:19|20)\d\d(?:\s*[-–]\s*(?:19|20)\d\d)?", 0.5),
    Rule(3, "copyright", ("©",), r"©\s*(?:19|20)\d\d(?:\s*[-–]\s*(?:19|20)\d\d)?", 0.5),
    Rule(3, "copyright", ("c",), r"\(c\)\s*(?:19|20)\d\d(?:\s*[-–]\s*(?:19|20)\d\d)?", 0.4),
    Rule(3, "unknown-license", ("licensed", "licenced"), r"licen[sc]ed\s+under\s+(?:the\s+)?[a-z0-9][a-z0-9 .-]{1,38}[a-z0-9]", 0.3),
]


def _spaced(name: str) -> str:
    """name, in which a space stands for any white space."""
    return name.replace("[ -]", r"(?:\s+|-)").replace(" ?", r"\s*").replace(" ", r"\s+")


def rules() -> list[Rule]:
    """All rules in order: for each family its SPDX line, its URL, a grant under its name, its name as a license and its bare name with a version; then those written by hand."""
    out = []
    for label, keywords, name, spdx, url in FAMILIES:
        name = _spaced(name)
        bounded = rf"(?<![a-z0-9]){name}"
        out.append(Rule(0, label, ("spdx",), rf"spdx-license-identifier:\s*\(?{_spaced(spdx)}(?![a-z0-9.+-])", 1.0))
        if url:
            host = re.sub(r"\\(.)", r"\1", url).split("/")[0].split(".")
            out.append(Rule(1, label, (host[-2],), rf"(?:https?://)?(?:www\.)?{url}", 0.9))
        out.append(Rule(1, label, keywords, rf"{_GRANT}{name}(?:(?:\s+|-)(?:public\s+)?licen[sc]e)?(?![a-z0-9])", 0.95))
        out.append(Rule(2, label, keywords, rf"{bounded}(?:\s+|-)(?:public\s+)?licen[sc]e(?![a-z0-9])", 0.8))
        if r"\." in name:
            out.append(Rule(3, label, keywords, rf"{bounded}(?![a-z0-9])", 0.6))
    return out + TEXTS


BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


#: Items of a run; see _gathered.
RUN = 256


def lower_ascii(text: Column) -> Column:
    """A-Z as a-z; a text of one byte a character takes the short way."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def _literal() -> Column:
    return F.array(*[F.struct(F.lit(i).alias("id"), F.lit(r.priority).alias("priority"), F.lit(r.label).alias("label"), F.array(*map(F.lit, r.keywords)).alias("keywords"), F.lit(r.regex).alias("regex"), F.lit(r.confidence).alias("confidence")) for i, r in enumerate(rules())])


def _present(text: Column, words: Column) -> Column:
    """The keywords that a text holds: those among its words, and the sign that may stick to a number."""
    keywords = sorted({k for r in rules() for k in r.keywords} - {"©"})
    sign = F.when(F.contains(text, F.lit("©")), F.array(F.lit("©"))).otherwise(F.array().cast("array<string>"))
    return F.concat(F.array_intersect(F.array(*map(F.lit, keywords)), words), sign)


def _gathered(rows: Column, kind: str, state: dict[str, Column], step) -> Column:
    """The items, of the given type, that step makes of rows one after the other. step(state, row) gives the next state, an item, and a condition under which the item counts (None: always).

    An array that is appended to is copied each time, so items are gathered in runs of RUN, and full runs in an array of their own: a text with many items costs little more per item than one with few.
    """
    start = F.struct(*[v.alias(k) for k, v in state.items()], F.array().cast(f"array<{kind}>").alias("run"), F.array().cast(f"array<array<{kind}>>").alias("full"))

    def merge(a: Column, x: Column) -> Column:
        after, item, counts = step(a, x)
        one = F.array(item)
        if counts is not None:
            one = F.when(counts, one).otherwise(F.array().cast(f"array<{kind}>"))
        ended = F.size(a["run"]) >= RUN
        run = F.when(ended, one).otherwise(F.concat(a["run"], one))
        full = F.when(ended, F.concat(a["full"], F.array(a["run"]))).otherwise(a["full"])
        return F.struct(*[v.alias(k) for k, v in after.items()], run.alias("run"), full.alias("full"))

    return F.aggregate(rows, start, merge, lambda a: F.flatten(F.concat(a["full"], F.array(a["run"]))))


def _places(text: Column, rule: Column) -> Column:
    """Detections of one rule: its matches part the text, and the lengths of parts and matches give their places."""

    def run(parts: Column) -> Column:
        found = F.regexp_extract_all(text, rule["regex"], F.lit(0))
        lengths = F.zip_with(F.slice(parts, 1, F.size(parts) - 1), found, lambda p, m: F.struct(F.length(p).alias("gap"), F.length(m).alias("own")))

        def step(a: Column, x: Column):
            start = a["at"] + x["gap"]
            end = start + x["own"]
            return {"at": end}, F.struct(start.alias("start"), end.alias("end")), None

        places = _gathered(lengths, "struct<start:int,end:int>", {"at": F.lit(0)}, step)
        return F.transform(places, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), rule["priority"].alias("priority"), rule["id"].alias("id"), rule["label"].alias("label"), rule["confidence"].alias("confidence")))

    return let(F.split(text, rule["regex"], -1), run)


def _unsuppressed(found: Column) -> Column:
    """found, sorted by (start, longest first, priority, rule), without what lies in an earlier one of equal or better priority. The state holds how far detections of each priority or a better one reach so far."""
    kind = "struct<start:int,end:int,priority:int,rule:int,label:string,confidence:double>"
    reach = [f"r{p}" for p in range(4)]

    def step(a: Column, s: Column):
        end = -s["back"]
        inside = F.coalesce(*[F.when(s["priority"] == p, a[r] >= end) for p, r in enumerate(reach)])
        own = F.struct(s["start"].alias("start"), end.alias("end"), s["priority"].alias("priority"), s["id"].alias("rule"), s["label"].alias("label"), s["confidence"].alias("confidence"))
        return {r: F.when(s["priority"] <= p, F.greatest(a[r], end)).otherwise(a[r]) for p, r in enumerate(reach)}, own, ~inside

    return _gathered(F.array_sort(found), kind, {r: F.lit(-1) for r in reach}, step)


def detections(text: Column, words: Column) -> Column:
    """array<struct<start,end,priority,rule,label,confidence>> over a text in lower case and its words; places in code points, end exclusive."""
    none = F.array().cast("array<struct<start:int,end:int,priority:int,rule:int,label:string,confidence:double>>")

    def of(present: Column) -> Column:
        held = F.filter(_literal(), lambda r: F.arrays_overlap(r["keywords"], present) & (F.regexp_instr(text, r["regex"]) > 0))
        return F.when(F.size(present) > 0, _unsuppressed(F.flatten(F.transform(held, lambda r: _places(text, r))))).otherwise(none)

    return let(_present(text, words), of)


def _phrase_places(words: Column, phrase: str, label: str) -> Column:
    first, *rest = phrase.split(" ")

    def here(w: Column, i: Column) -> Column:
        all_ = w == first
        for k, r in enumerate(rest):
            all_ &= F.coalesce(F.get(words, i + k + 1) == r, F.lit(False))
        return F.when(all_, F.struct(i.alias("at"), F.lit(label).alias("label")))

    places = F.filter(F.transform(words, here), lambda x: x.isNotNull())
    return F.when(F.array_contains(words, first) & F.array_contains(words, rest[-1]), places).otherwise(F.array().cast("array<struct<at:int,label:string>>"))


def base_places(words: Column) -> Column:
    """array<struct<at,label>> of every place where a base phrase's words stand consecutively, in order of the words."""
    return F.array_sort(F.concat(*[_phrase_places(words, phrase, label) for phrase, label in BASE.items()]))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, base array<struct<at,label>>, found array<struct<..>>) of every row."""

    def of_text(t: Column) -> Column:
        words = F.array_remove(F.split(t, _NO_WORD), "")
        return let(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), base_places(w).alias("base"), detections(t, w).alias("found")))

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), let(lower_ascii(text_of(text)), of_text).alias("s"))
    return rows.select("doc_id", "s.n_words", "s.base", "s.found")


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan(table(spark, sf_dir, "documents"))
    base, found = F.col("base"), F.col("found")
    base_labels = F.array_sort(F.array_distinct(base["label"]))
    labels = F.array_sort(F.array_distinct(F.concat(base["label"], found["label"])))
    score = F.coalesce(F.array_max(found["confidence"]), F.lit(0.0))
    return rows.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(base["at"]).cast("long").alias("first_word"),
        F.array_max(base["at"]).cast("long").alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.greatest(score, F.when(F.size(base) > 0, F.lit(0.5)).otherwise(F.lit(0.0))).alias("score"),
        F.size(found).cast("long").alias("n_detections"),
    )
