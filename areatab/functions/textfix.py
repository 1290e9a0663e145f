"""Repair of Spanish text damaged into U+FFFD ('�').

Source files had accented letters replaced by the Unicode replacement
character. Repair is an ordered list of rules applied one after another to
whole texts; later rules see the output of earlier ones, so order matters and
``(pattern, replacement, kind)`` with ``kind`` "literal" (plain substring) or
"regex" (word-boundary and anchor rules).

There are two ways to apply them, with equal results. ``repair`` compiles them
to one nested native expression (``replace`` / ``regexp_replace``): for labels
and names, where a text is a few words. ``repair_text`` is for whole texts: a
rule that has no blank but at an end of its pattern sees nothing beyond the word
and the blanks beside it, so a run of such rules is applied to each damaged word
alone, in one pass over the text, and each distinct word is worked out once.

Every rule pattern contains '�', so texts without one are returned untouched.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

RC = "�"

Rule = tuple[str, str, str]

# ---------------------------------------------------------------------------
# Rule lists that must equal the published processing exactly.
# Patterns are written in the R regex dialect, in application order.
# ---------------------------------------------------------------------------

# 1991 vintage: 21 word rules, then every remaining '�' becomes 'ó'.
RULES_1991: tuple[Rule, ...] = (
    ("Var�n", "Varón", "literal"),
    ("ca�er�a", "cañería", "literal"),
    ("Asisti�", "Asistió", "literal"),
    ("asisti�", "asistió", "literal"),
    ("Jard�n", "Jardín", "literal"),
    ("c�mara", "cámara", "literal"),
    ("C�mara", "Cámara", "literal"),
    ("s�ptic", "séptic", "literal"),
    ("p�blic", "públic", "literal"),
    ("habitaci�n", "habitación", "literal"),
    ("Pensi�n", "Pensión", "literal"),
    ("M�vil", "Móvil", "literal"),
    ("Cer�mic", "Cerámic", "literal"),
    ("cer�mic", "cerámic", "literal"),
    ("pl�stic", "plástic", "literal"),
    ("dom�stic", "doméstic", "literal"),
    ("C�nyuge", "Cónyuge", "literal"),
    ("c�nyuge", "cónyuge", "literal"),
    ("relaci�n", "relación", "literal"),
    ("pr�stamo", "préstamo", "literal"),
    ("cesi�n", "cesión", "literal"),
    ("�", "ó", "literal"),
)

# 2001 vintage: 104 rules, no fallback.
RULES_2001: tuple[Rule, ...] = (
    ("a�os", "años", "literal"),
    ("A�os", "Años", "literal"),
    (r"a�o\b", "año", "regex"),
    ("ci�n", "ción", "literal"),
    ("si�n", "sión", "literal"),
    ("c�nyuge", "cónyuge", "literal"),
    ("C�nyuge", "Cónyuge", "literal"),
    ("n�cleo", "núcleo", "literal"),
    ("N�cleo", "Núcleo", "literal"),
    (r"m�s\b", "más", "regex"),
    ("t�rmino", "término", "literal"),
    ("tel�fono", "teléfono", "literal"),
    ("p�blic", "públic", "literal"),
    ("desag�e", "desagüe", "literal"),
    ("pa�s", "país", "literal"),
    ("dom�stic", "doméstic", "literal"),
    ("m�rmol", "mármol", "literal"),
    ("cer�mic", "cerámic", "literal"),
    ("Cer�mic", "Cerámic", "literal"),
    ("ca�er", "cañer", "literal"),
    ("s�ptic", "séptic", "literal"),
    ("s�lo", "sólo", "literal"),
    ("pr�stamo", "préstamo", "literal"),
    ("m�dic", "médic", "literal"),
    ("c�mara", "cámara", "literal"),
    ("autom�tic", "automátic", "literal"),
    ("veh�cul", "vehícul", "literal"),
    ("t�cnic", "técnic", "literal"),
    ("Asisti�", "Asistió", "literal"),
    ("asisti�", "asistió", "literal"),
    ("aprob�", "aprobó", "literal"),
    ("b�sic", "básic", "literal"),
    ("econ�mic", "económic", "literal"),
    ("el�ctric", "eléctric", "literal"),
    ("qu�mic", "químic", "literal"),
    ("f�sic", "físic", "literal"),
    ("matem�tic", "matemátic", "literal"),
    ("estad�stic", "estadístic", "literal"),
    ("jard�n", "jardín", "literal"),
    ("com�n", "común", "literal"),
    ("n�mero", "número", "literal"),
    ("Mart�n", "Martín", "literal"),
    ("L�pez", "López", "literal"),
    ("Mor�n", "Morón", "literal"),
    ("Col�n", "Colón", "literal"),
    ("Jos�", "José", "literal"),
    ("Ju�rez", "Juárez", "literal"),
    ("Gonz�l", "González", "literal"),
    ("Rodr�guez", "Rodríguez", "literal"),
    ("Fern�ndez", "Fernández", "literal"),
    ("Bah�a", "Bahía", "literal"),
    ("Mar�a", "María", "literal"),
    ("R�o ", "Río ", "literal"),
    ("R�o$", "Río", "regex"),
    ("Per�n", "Perón", "literal"),
    ("Lan�s", "Lanús", "literal"),
    ("Jun�n", "Junín", "literal"),
    ("Luj�n", "Luján", "literal"),
    ("Paran�", "Paraná", "literal"),
    ("G�e", "Güe", "literal"),
    ("Echeverr�a", "Echeverría", "literal"),
    ("Ituzaing�", "Ituzaingó", "literal"),
    ("Hip�lito", "Hipólito", "literal"),
    ("Bartolom�", "Bartolomé", "literal"),
    ("Nicol�s", "Nicolás", "literal"),
    ("Andr�s", "Andrés", "literal"),
    ("Bol�var", "Bolívar", "literal"),
    ("Su�rez", "Suárez", "literal"),
    ("P�rez", "Pérez", "literal"),
    ("Capit�n", "Capitán", "literal"),
    ("Ca�uelas", "Cañuelas", "literal"),
    ("Z�rate", "Zárate", "literal"),
    ("Chascom�s", "Chascomús", "literal"),
    ("Maip�", "Maipú", "literal"),
    ("Ober�", "Oberá", "literal"),
    ("Iguaz�", "Iguazú", "literal"),
    ("Bel�n", "Belén", "literal"),
    ("Or�n", "Orán", "literal"),
    ("Met�n", "Metán", "literal"),
    ("Pueyrred�n", "Pueyrredón", "literal"),
    ("Pe�aloza", "Peñaloza", "literal"),
    ("Olavarr�a", "Olavarría", "literal"),
    ("Gualeguaych�", "Gualeguaychú", "literal"),
    ("Guamin�", "Guaminí", "literal"),
    ("Pehuaj�", "Pehuajó", "literal"),
    ("Tapalqu�", "Tapalqué", "literal"),
    ("Salliquel�", "Salliquelló", "literal"),
    ("Andalgal�", "Andalgalá", "literal"),
    ("Guaymall�n", "Guaymallén", "literal"),
    ("Tunuy�n", "Tunuyán", "literal"),
    ("Taf�", "Tafí", "literal"),
    ("Jer�nimo", "Jerónimo", "literal"),
    ("Ant�rtida", "Antártida", "literal"),
    ("asf�ltic", "asfáltic", "literal"),
    ("pl�stic", "plástic", "literal"),
    ("cart�n", "cartón", "literal"),
    ("hormig�n", "hormigón", "literal"),
    (r"�a\b", "ía", "regex"),
    (r"�n\b", "ón", "regex"),
    ("^�o", "Ño", "regex"),
    (" �o", " Ño", "literal"),
    ("1�", "1°", "literal"),
    ("�$", "ó", "regex"),
    ("� ", "ó ", "literal"),
)

# Names and words that the 2001 rules get wrong or leave damaged, spelled right.
CORRECT_WORDS: tuple[str, ...] = (
    "González", "Tucumán", "Neuquén", "Salliqueló", "Pirané", "Córdoba", "Entre Ríos", "Río Negro", "Río Cuarto",
    "Ciudad Autónoma", "Jáchal", "País", "país", "niño", "niña", "Niño", "Niña", "compañía", "Compañía",
)


def damage(text: str) -> str:
    """``text`` as the source files have it: every accented letter is '�'."""
    return "".join(RC if not c.isascii() and c.isalpha() else c for c in text)


# The 2001 rules with those words mended first, as whole strings, so that no later rule meets them.
RULES_CORRECTED: tuple[Rule, ...] = tuple((damage(w), w, "literal") for w in CORRECT_WORDS) + RULES_2001

RULE_SETS = {"1991": RULES_1991, "2001": RULES_2001, "corrected": RULES_CORRECTED}


def java_pattern(pattern: str) -> str:
    """R (TRE) pattern -> Java pattern with the same meaning.

    Without multi-line mode R's ``$`` matches only at the very end of the
    string, while Java's ``$`` also matches before a final line break, so a
    trailing ``$`` becomes ``\\z``. A closing ``\\b`` means that no letter, mark,
    digit or ``_`` follows; it is spelled out, since what ``\\b`` takes for a
    letter differs between Java versions. ``^`` already agrees.
    """
    if pattern.endswith("\\b"):
        return pattern[:-2] + r"(?![\p{L}\p{M}\p{N}_])"
    if pattern.endswith("$") and not pattern.endswith("\\$"):
        return pattern[:-1] + "\\z"
    return pattern


def repair(text: Column | str, rules: Sequence[Rule] | str = "2001") -> Column:
    """Apply the rules in order to whole texts. NULL stays NULL."""
    if isinstance(rules, str):
        rules = RULE_SETS[rules]
    c = F.col(text) if isinstance(text, str) else text
    out = c
    for pattern, replacement, kind in rules:
        if kind == "literal":
            out = F.replace(out, F.lit(pattern), F.lit(replacement))
        elif kind == "regex":
            out = F.regexp_replace(out, java_pattern(pattern), replacement)
        else:
            raise ValueError(f"unknown rule kind {kind!r}")
    return F.when(F.instr(c, RC) > 0, out).otherwise(c)


#: Distinct words that a worker remembers at most for a run of rules, and the longest of them: a few MB, whatever the input.
REMEMBERED, WORD = 20_000, 64
#: Bytes of text that a worker holds decoded at once; one longer text is a slice of its own.
SLICE_BYTES = 1 << 20


def sees_one_word(rule: Rule) -> bool:
    """Whether a rule's matches lie in a run of characters between blanks, with at most one blank at one end.

    The replacement must keep that blank, so that the words around it stay as they are.
    """
    pattern, replacement, kind = rule
    if kind == "regex":
        pattern = pattern.removeprefix("^").removesuffix("\\b").removesuffix("$")
        if regex.escape(pattern, special_only=True, literal_spaces=True) != pattern:
            return False
    core = pattern.strip(" ")
    ends = len(pattern) - len(pattern.lstrip(" ")), len(pattern) - len(pattern.rstrip(" "))
    kept = len(replacement) - len(replacement.lstrip(" ")), len(replacement) - len(replacement.rstrip(" "))
    return " " not in core and " " not in replacement.strip(" ") and RC in core and ends in ((0, 0), (0, 1), (1, 0)) and ends == kept


def _steps(rules: Sequence[Rule]) -> Callable[[str], str]:
    """The rules one after the other, as plain Python; a rule is tried where the text holds its letters."""
    steps: list[tuple[str, str, regex.Pattern | None]] = []
    for pattern, replacement, kind in rules:
        if kind == "literal":
            steps.append((pattern, replacement, None))
        elif kind == "regex":
            core = pattern.removeprefix("^").removesuffix("\\b").removesuffix("$") if sees_one_word((pattern, replacement, kind)) else ""
            steps.append((core, replacement, regex.compile(java_pattern(pattern).replace("\\z", "\\Z"))))
        else:
            raise ValueError(f"unknown rule kind {kind!r}")

    def run(text: str) -> str:
        for core, replacement, find in steps:
            if core in text:
                text = text.replace(core, replacement) if find is None else find.sub(lambda _, r=replacement: r, text)
        return text

    return run


@cache
def repairer(rules: tuple[Rule, ...]) -> Callable[[str], str]:
    """The rules in order on a whole text: runs of rules that see one word by words, the others as they are."""
    runs: list[tuple[bool, list[Rule]]] = []
    for rule in rules:
        alone = sees_one_word(rule)
        if not runs or runs[-1][0] != alone:
            runs.append((alone, []))
        runs[-1][1].append(rule)

    def by_words(own: Sequence[Rule]) -> Callable[[str], str]:
        fix, known = _steps(own), {}

        def word(key: tuple[str, bool, bool]) -> str:
            # the blank before and after it, or the text's ends, are all that the rules see of the rest
            own, before, after = key
            fixed = fix(" " * before + own + " " * after)
            out = fixed[before : len(fixed) - after]
            if len(own) <= WORD:
                if len(known) >= REMEMBERED:
                    known.clear()
                known[key] = out
            return out

        def run(text: str) -> str:
            words = text.split(" ")
            last = len(words) - 1
            for i, own in enumerate(words):
                if RC in own:
                    key = (own, i > 0, i < last)
                    found = known.get(key)
                    words[i] = word(key) if found is None else found
            return " ".join(words)

        return run

    parts = [by_words(own) if alone else _steps(own) for alone, own in runs]

    def run(text: str) -> str:
        for part in parts:
            text = part(text)
        return text

    return run


def repaired(texts: pa.Array, rules: tuple[Rule, ...]) -> Iterator[pa.Array]:
    """The rules on each text of a batch, slice by slice: a batch of long texts takes little more than itself."""
    fix = repairer(rules)
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(sizes) - sizes) // SLICE_BYTES
    starts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist()]
    for a, b in zip(starts, [*starts[1:], len(texts)], strict=True):
        yield pa.array([None if t is None else fix(t) for t in texts.slice(a, b - a).to_pylist()], pa.string())


def repair_text(text: Column | str, rules: Sequence[Rule] | str = "2001") -> Column:
    """The same as :func:`repair`, for long texts: one pass over each, whatever the number of rules. NULL stays NULL."""
    own = tuple(RULE_SETS[rules] if isinstance(rules, str) else map(tuple, rules))
    c = F.col(text) if isinstance(text, str) else text

    @F.arrow_udf("string")
    def fixed(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield from repaired(column, own)

    # texts without damage don't leave the JVM
    return F.coalesce(fixed(F.when(F.instr(c, RC) > 0, c)), c)


def count_damaged(text: Column | str) -> Column:
    """Number of '�' left in a text (0 for NULL)."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.length(c) - F.length(F.replace(c, F.lit(RC), F.lit(""))), F.lit(0)).cast("long")
