"""Template residue, filler and error pages in place of real text.

Two findings make a document residue:

* *Template*: at least two places of one delimiter style still hold a mark. Each style has its own grammar, tried where its
  opener stands. Context and density discount: marks inside code, and in sentences that talk about marks or define them,
  do not count, and where there are more of those than others the text is a tutorial.
* *Nothing but*: after page furniture (menus, titles, footers, ids) is set aside, every remaining sentence is filler,
  an error message or a notice about scripts. One sentence of real content clears the document. A sentence is an error
  message by its build: a thing of the web (page, server, feed, and the like) that failed, a status code with its short
  title, or the wording of a program's fault; a word like "error" or "sorry" alone is none.

Whole texts are read, each in its own row: there is no shuffle and no state.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NAME = r"[A-Za-z][A-Za-z0-9_. -]*"
HTML = r"(?:p|br|b|i|u|s|a|em|strong|div|span|ul|ol|li|h[1-6]|table|tr|td|th|tbody|thead|img|html|body|head|title|pre|code|hr|blockquote|script|style|sub|sup|small|font|center|nav|footer|header|section|article|main|form|input|button|label)"

# Each style's openers, one of which its text holds, and its grammar; a document needs two marks of one style.
GRAMMARS = {
    "mustache": (("{{",), rf"\{{\{{[{{#/&>^]?\s*{NAME}\s*\}}?\}}\}}"),
    "jinja": (("{%",), r"\{%[^{}%\n]+%\}"),
    "dollar": (("${",), rf"\$\{{\s*{NAME}\s*\}}"),
    "brace": (("{",), rf"(?<![\{{\$%#])\{{\s*{NAME}\s*\}}(?!\}})"),
    "printf": (("%",), r"%\([A-Za-z_][A-Za-z_ ]*\)[sdfi]|(?<![0-9])(?<![0-9] )%[sdif]\b|(?<=[0-9] )%[sdif]\b"),
    "percent": (("%",), r"%[A-Za-z][A-Za-z_]+%"),
    "double_bracket": (("[[",), rf"\[\[\s*{NAME}\s*\]\]"),
    "insert": (("[",), r"\[(?:insert|enter|your|add|name of|put|type)\b[^\[\]\n]*\]"),
    "bracket": (("[",), r"(?<!\[)\[(?=[^\[\]]*[a-z])[A-Z][a-z]+(?: [A-Z]?[a-z]+)*\](?![\]\(])"),
    "double_angle": (("<<", "«"), rf"<<\s*{NAME}\s*>>|«\s*{NAME}\s*»"),
    "erb": (("<%",), r"<%[=-]?[^<>%\n]+%>"),
    "angle": (("<",), rf"(?<![<\w])<(?!/?{HTML}\b)[a-z][a-z_]+(?:[ _-][a-z]+)*>(?!>)"),
    "underscores": (("__",), r"(?<![\w_])__[A-Za-z][A-Za-z_]*?__(?![\w_])"),
    "blank": (("____",), r"(?<![\w_])_{4,}(?![\w_])"),
    "at": (("@",), r"(?<![\w@])@[A-Za-z][A-Za-z_]*@(?![\w@])"),
    "hash": (("#",), r"(?<![\w#])#[A-Z][A-Za-z_]+#(?![\w#])"),
    "null": (("null", "NULL", "NaN"), r"\b(?:null|NULL|NaN)\b"),
    "undefined": (("undefined",), r"\bundefined\b"),
    "none": (("None", "[object"), r"(?<![\w'])None(?![\w'])(?= (?:yards?|to|on|for|and|of|with|in|at|by)\b)|\[object Object\]"),
    "xxx": (("XXX",), r"\bX{3,}\b"),
    "prefix": (("_",), r"\b(?:TBC|TBD|TBA|TODO|FIXME|INSERT|FILL|FIELD|VAR|PLACEHOLDER)_[A-Za-z][A-Za-z_]*"),
    "todo": (("TBD", "TODO", "TBC", "TBA"), r"\b(?:TBD|TODO|TBC|TBA)\b"),
}
GRAMMARS = {style: (openers, re.compile(grammar)) for style, (openers, grammar) in GRAMMARS.items()}
#: A sentence with one of these talks about marks, or says what one means, instead of holding them.
ABOUT = re.compile(
    r"(?i)\b(?:templates?|placeholders?|(?:curly |square |angle )?(?:braces?|brackets?)|notation|syntax|variables?|macros?|delimiters?|shorthand|escaped?|for example|e\.g\.|means?|denotes?|stands? for|represents?|refers? to|"
    r"platzhalter|vorlagen?|klammern?|bedeutet|plantillas?|corchetes|llaves|significan?|gabarits?|accolades|crochets|signifient?|signifie|aaltosulkeet|merkitsee|tarkoittaa)\b"
)
MARKED = re.compile(r"<[^<>]*>|\{[^{}]*\}|\[[^\[\]]*\]|%\w+%|__\w+__|@\w+@")
CODE = re.compile(r"(?s)```.*?```|~~~.*?~~~|(?m:^(?: {4}|\t)\S.*$)|`[^`\n]+`")

# Wording of notices about scripts, of error messages and of filler, in lower case.
SCRIPTS = (
    r"java ?script|\bjs\b|no ?script|\bscripts?\b|\bcookies?\b|ad ?blocker|your blocker|checking your browser|your browser|this browser|bitte\b.*aktivier|käyttöön|then press reload|robot|captcha|takes a few seconds|^loading\W*$|one moment|"
    r"enable it in|reload (?:the|this) page|turn (?:it|them) on|and reload\b|skripte?\b|navigateur|navegador|selaime"
)
# Words that tell of a fault anywhere; they count where the sentence is short or names a thing of the web.
FAULTS = (
    r"\b(?:error|errors|erreur|fehler|virhe|fatal|exception|warning|forbidden|oops|sorry|fail(?:s|ed|ure)?|closed|refused|reset|dropped|lost|broken|removed|retired|deleted|missing|offline|overload(?:ed)?|blocked|expired|interrupted|terminated|invalid)\b|"
    r"not found|does ?n[o']t exist|doesn't exist|no longer (?:here|available|exists?)|any more\b\W*(?:\w+\W*)?$|timed? ?out\b|is down\b|are down\b|down for|maintenance|planned work|not available|unavailable|"
    r"could not be|cannot be|can't be|moved or|(?:have|has) been (?:moved|deleted|told|removed|reported)|are looking into|permission|not (?:allowed|authori[sz]ed)|went wrong|run out|archived|parked|"
    r"retirad[ao]s?|eliminad[ao]s?|movid[ao]s?|suspendid[ao]s?|caíd[ao]|no (?:está )?disponible|no existe|no (?:se )?(?:ha )?(?:sido )?(?:encontr|carg|pued)|más tarde|inténtelo|intentelo|en obras|en construcción|en mantenimiento|"
    r"introuvable|indisponible|supprimée?|déplacée?|expirée?|réessay|en travaux|échou|n'existe (?:pas|plus)|erreichbar|nicht gefunden|nicht verfügbar|nicht vorhanden|gelöscht|entfernt|verschoben|abgelaufen|fehlgeschlagen|später (?:noch einmal|erneut)|wartung|im aufbau|"
    r"ei löytynyt|ei ole|poistettu|siirretty|vanhentunut|epäonnistui|yritä (?:myöhemmin )?uudelleen|huolto"
)
WEB = (
    r"\b(?:web ?)?(?:pages?|sites?|servers?|urls?|links?|hosts?|hosting|upstream|downstream|gateway|prox(?:y|ies)|firewall|browser|http|https|dns|ssl|tls|api|apps?|application|database|query|backend|cache|connection|network|requests?|responses?|sessions?|"
    r"accounts?|log ?in|sign ?in|password|token|domains?|address|resource|documents?|files?|content|downloads?|uploads?|service|portal|stream|player|video|archive|feed|ticker|profile|chart|view|list|image|form|module|script|loading|load(?:ed)?|render(?:ed|ing)?|display(?:ed)?|system|admin(?:istrator)?|webmaster|support|this play-by-play)\b|"
    r"página|sitio|servidor|enlace|conexión|solicitud|servicio|\bpage\b|serveur|\blien\b|connexion|requête|service|\bsite\b|seite|webseite|\bserver|verbindung|anfrage|dienst|adresse|sivu|palvelin|palvelu|yhtey|pyyntö|osoite|linkki"
)
# Wording that only error messages have.
ERRORS = (
    r"\btraceback\b|took too long|request limit|too many (?:requests|calls)|rate limit|empty response|failed while|cannot be (?:shown|loaded|displayed)|can't be (?:shown|loaded)|access denied|sign in (?:again )?to|log ?in to|session (?:has )?(?:expired|ended|timed)|"
    r"algo ha (?:ido|salido) mal|something went wrong|keeps happening|please contact|check the (?:address|link|url)|\.[a-z]+exception\b|^\w+(?:error|exception): |undefined (?:index|variable|offset)|null ?pointer|stack trace|segmentation|core dumped|at line \w*\d|on line \d|"
    r"try again|check back (?:later|soon|in)|réessay|inténtelo|intentelo|später (?:noch einmal|erneut)|yritä (?:myöhemmin )?uudelleen|been (?:archived|deleted|taken down|relocated)|moved or (?:been )?(?:deleted|removed)|"
    r"internal server|bad request|bad gateway|service is|(?:did|does) not respond|unexpected condition|stopped this request|could not load|can(?:'|no)t find|cannot find|contact the (?:site|page|web)|^go back to|^return to|signed-in|goes? offline|^panic:|^fatal:|null ?reference|out of range|in your country|in your region|"
    r"^timeout\b|index \d+|server took|status code|incident|reference (?:id|number|code)|^sql error|404 not found|no hemos encontrado|été trouvée|est introuvable|we have been told|have been told|been told and are|do not have permission"
)
STATUS = r"^\W*(?:http(?:/\d(?:\.\d)?)? ?|error ?|fehler ?|erreur ?|virhe ?|código ?|code ?)*[45]\d\d\b\W*(?:\w+\W*){0,6}$"
FILLER = (
    r"\blorem\b|\bipsum\b|platzhalter|blindtext|dummy (?:copy|text)|sample text|filler text|placeholder (?:copy|text)|replace this|your \w+ (?:goes|go|comes) here|your (?:text|content|story|headline) here|write something|type something|"
    r"texto de (?:relleno|ejemplo|prueba)|texte (?:de remplissage|d'exemple|fictif)|faux texte|täyteteksti|esimerkkiteksti|coming soon|under construction|insert (?:text|title|story)|bitte ersetzen|à remplacer|remplacer ce|sustituir|reemplace|korvaa|"
    r"tähän tulee|hier (?:kommt|steht|folgt|entsteht)|aquí (?:va|irá)|\bici (?:le|la|votre|vient)|\badd (?:an?|your|some|the)\b.*\bhere\b|max\. \d+ (?:characters|words|zeichen)|^\d+ (?:characters|words|zeichen)\b|"
    r"\bblah blah\b|\basdf|\bqwerty|\bfoo bar\b|\btest test\b|^\W*(?:sitio|página|site|page|seite|website|sivu(?:sto)?)\b.*(?:en obras|en construcción|en construction|en travaux|im aufbau|in arbeit|rakenteilla|työn alla)"
)
FURNITURE = (
    r"^(?:[^|]*\|){2,}[^|]*$|^you are here\b|^< ?back\b|^‹|^«|^\(c\)|^©|\bimprint\b|\bimpressum\b|^privacy|^skip to\b|^(?:\S+ {2,}){2,}\S+$|^(?:start|home) ?[>»/]|"
    r"^(?:ray|ref|reference|incident|id|request|trace|code|support|case|event|session)[ :#.-]*(?:id|no|code|number)?[ :#.-]*[0-9a-f-]*[0-9][0-9a-f-]*\.?$|^[0-9a-f]{6,}\.?$|^[0-9\W_]+$|^(?:share|print|menu|search|login|log in|next match|back|ok|close|accept)\W*$"
)
TAGGED_ID = r"(?i)\b(?:ray|ref|reference|incident|id|request|trace|code|support|case|event|session|build)\b(?: (?:id|no|code|number)\b)?[ :#.-]*\b(?=[0-9a-f-]*[0-9])[0-9a-f][0-9a-f-]{5,}\b\.?"
TAGGED_ID = re.compile(r"(?i)\b(?:ray|ref|reference|incident|id|request|trace|code|support|case|event|session|build)\b(?: (?:id|no|code|number)\b)?[ :#.-]*\b(?=[0-9a-f-]*[0-9])[0-9a-f][0-9a-f-]{5,}\b\.?")
FUNCTION = frozenset("the a an and or of to in on at for with by from is was are were it this that his her their not but as der die das und ein eine im den von mit nicht el la los las y en de un una con por le les et des une dans sur avec on ja oli ei se kun".split())
#: Words up to which a sentence that only tells of a fault is an error message.
SHORT = 4
SCRIPTS, FAULTS, WEB, ERRORS, STATUS, FILLER, FURNITURE = map(re.compile, (SCRIPTS, FAULTS, WEB, ERRORS, STATUS, FILLER, FURNITURE))
TAGS, ENDS = re.compile(rf"(?i)</?{HTML}\b[^<>]*>"), re.compile(r"(?<=[.!?…])\s+| - (?=[A-Za-z])")
STOPS = re.compile(r"(?<=[.!?])\s+")


def _sentences(text: str) -> Iterator[str]:
    """Sentence by sentence, lines of furniture whole; lazily, as the first real one decides."""
    for line in (TAGS.sub("\n", text) if "<" in text else text).split("\n"):
        line = TAGGED_ID.sub("", line.strip().strip("*#>")).strip()
        words = line.split()
        if FURNITURE.search(line.lower()) or len(words) >= 4 and len(set(words)) <= 2:
            yield line
        elif line:
            yield from (t for s in ENDS.split(line) if (t := s.strip()).strip(" .-"))


def _is_title(s: str) -> bool:
    words = re.findall(r"[^\W\d_]+", s)
    return len(words) <= 6 and not re.search(r"[.!?:;,]$", s) and all(w[0].isupper() for w in words)


def _repeats(s: str) -> bool:
    """Words that say nothing: hardly any different ones, or no function word among many."""
    words = re.findall(r"[\w/]+", s.lower())
    return len(words) >= 6 and len(set(words)) <= min(6, 0.34 * len(words) + 1) or len(words) >= 12 and len(set(words)) < 0.75 * len(words) and not FUNCTION & set(words)


def is_error(low: str) -> bool:
    """Whether a sentence in lower case is an error message: by its own wording, a status code, or a thing of the web that failed."""
    return bool(ERRORS.search(low) or STATUS.search(low) or FAULTS.search(low) and (len(low.split()) <= SHORT or WEB.search(low)))


def kind_of_sentence(s: str) -> str:
    """``furniture``, ``scripts``, ``error``, ``filler`` or ``content``."""
    low, words = s.lower(), s.split()
    if len(words) >= 4 and len(set(words)) <= 2:
        return "filler"
    if FURNITURE.search(low):
        return "furniture"
    if SCRIPTS.search(low):
        return "scripts"
    if FILLER.search(low):
        return "filler"
    if is_error(low):
        return "error"
    return "filler" if _repeats(s) else "furniture" if _is_title(s) else "content"


def template_style(text: str) -> str | None:
    """The style with the most marks, if two or more are left outside code and talk about notation, and no fewer than inside."""
    found = {style: n for style, (openers, grammar) in GRAMMARS.items() if any(o in text for o in openers) and (n := len(grammar.findall(text))) >= 2}
    if not found:
        return None
    kept = "\n".join(s for line in CODE.sub(" ", text).split("\n") for s in STOPS.split(line) if not ABOUT.search(MARKED.sub(" ", s)))
    left = {style: n for style, whole in found.items() if (n := len(GRAMMARS[style][1].findall(kept))) >= 2 and 2 * n >= whole}
    return max(left, key=left.get) if left else None


def nothing_but(text: str) -> str | None:
    """The kind of residue that is all a text holds besides furniture, or None."""
    kinds = []
    for s in _sentences(text):
        kind = kind_of_sentence(s)
        if kind == "content":
            return None
        kinds.append(kind)
    left = [k for k in kinds if k != "furniture"]
    return max(set(left), key=lambda k: (left.count(k), k)) if left else None


def residue_kind(text: str | None) -> str | None:
    """``template:<style>``, ``scripts``, ``error`` or ``filler``; None for real, empty and null texts."""
    if not text or not text.strip():
        return None
    style = template_style(text)
    return f"template:{style}" if style else nothing_but(text)


def residue_column(text: Column) -> Column:
    """residue_kind of a text column, batch-wise."""

    @F.pandas_udf("string")
    def kinds(texts: pd.Series) -> pd.Series:
        return texts.map(residue_kind, na_action="ignore")

    return kinds(text)


def with_residue(documents: DataFrame, text: str = "text", into: str = "residue") -> DataFrame:
    """``documents`` with the kind of residue of each text (null for real text); a column ``into`` of its own is replaced.

    Null, empty and blank texts are no residue. Repeated rows and texts get the same answer each.
    """
    return documents.withColumn(into, residue_column(F.col(text)))
