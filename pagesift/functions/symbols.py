"""Unicode mathematics to LaTeX."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagesift.functions.html import replace_each

# Unicode names of the styled letters, and the LaTeX command of each style.
STYLED_NAME = re.compile(
    r"(?:MATHEMATICAL )?(BOLD ITALIC|BOLD|ITALIC|SCRIPT|DOUBLE-STRUCK) (?:(CAPITAL|SMALL) )?((?:FINAL )?[A-Z]+(?: SYMBOL| DIFFERENTIAL)?)"
)
PLAIN_GREEK_NAME = re.compile(r"GREEK (?:(CAPITAL|SMALL) LETTER )?([A-Z]+(?: SYMBOL)?)")
COMMANDS = {
    "BOLD": "mathbf", "ITALIC": "mathit", "BOLD ITALIC": "bm", "SCRIPT": "mathcal", "DOUBLE-STRUCK": "mathbb",
}
GREEK = (
    "ALPHA BETA GAMMA DELTA EPSILON ZETA ETA THETA IOTA KAPPA LAMDA MU NU XI OMICRON PI RHO SIGMA TAU UPSILON "
    "PHI CHI PSI OMEGA"
).split()
# Letter forms that LaTeX names otherwise than Unicode.
VARIANTS = {
    "EPSILON SYMBOL": "epsilon", "THETA SYMBOL": "vartheta", "KAPPA SYMBOL": "varkappa", "PHI SYMBOL": "varphi",
    "RHO SYMBOL": "varrho", "PI SYMBOL": "varpi", "NABLA": "nabla", "PARTIAL DIFFERENTIAL": "partial",
    "FINAL SIGMA": "varsigma",
}
# Where the styled letters stand: Greek, letter-like symbols, mathematical alphabets.
RANGES = ((0x391, 0x3D7), (0x2102, 0x2139), (0x1D400, 0x1D7CC))
# Signs without such a name, and letters whose name says something else.
SINGLES = {
    "\u00a0": "\\ ", "\u2016": r"\Vert ", "\u22ee": r"\vdots ", "\u22ef": r"\cdots ", "\u22f1": r"\ddots ",
    "\u210e": r"\mathit{h}", "\u2118": r"\wp ",
}

# Characters of text inside formulas.
TEXT_ENTITIES = {
    "\u2009\u200a\u200a": r"\hspace{0.28em}", "\u2002": r"\hspace{0.5em}", "\u2003": r"\hspace{1em}",
    "\u2004": r"\hspace{0.33em}", "\u2005": r"\hspace{0.25em}", "\u2009": r"\hspace{0.17em}",
    "\u200a": r"\hspace{0.05em}", "\u200b": "", "\u205f": r"\hspace{0.22em}",
    "$": r"\$", "#": r"\#", "&": r"\&", "%": r"\%", "_": r"\_",
}

# Common signs, arrows, operators and relations.
OPERATORS = {
    "£": r"\pounds ", "¥": r"\yen ", "§": r"\S ", "©": r"\copyright ", "¬": r"\neg ", "±": r"\pm ", "µ": r"\mu ",
    "×": r"\times ", "÷": r"\div ", "…": r"\dots ", "′": r"\prime ", "ℓ": r"\ell ", "ℜ": r"\Re ", "ℑ": r"\Im ",
    "ℕ": r"\mathbb{N}", "ℙ": r"\mathbb{P}", "ℚ": r"\mathbb{Q}", "ℤ": r"\mathbb{Z}", "ℵ": r"\aleph ",
    "←": r"\leftarrow ", "↑": r"\uparrow ", "→": r"\to ", "↓": r"\downarrow ", "↔": r"\leftrightarrow ",
    "↦": r"\mapsto ", "⇐": r"\Leftarrow ", "⇒": r"\Rightarrow ", "⇔": r"\Leftrightarrow ",
    "∀": r"\forall ", "∂": r"\partial ", "∃": r"\exists ", "∅": r"\varnothing ", "∇": r"\nabla ", "∈": r"\in ",
    "∉": r"\notin ", "∋": r"\ni ", "∏": r"\prod ", "∑": r"\sum ", "−": "-", "∓": r"\mp ", "∗": r"\ast ",
    "∘": r"\circ ", "√": r"\surd ", "∝": r"\propto ", "∞": r"\infty ", "∠": r"\angle ", "∣": r"\mid ",
    "∥": r"\parallel ", "∧": r"\wedge ", "∨": r"\vee ", "∩": r"\cap ", "∪": r"\cup ", "∫": r"\int ", "∬": r"\iint ",
    "∮": r"\oint ", "∴": r"\therefore ", "∵": r"\because ", "∼": r"\sim ", "≃": r"\simeq ", "≅": r"\cong ",
    "≈": r"\approx ", "≠": r"\ne ", "≡": r"\equiv ", "≤": r"\le ", "≥": r"\ge ", "≪": r"\ll ", "≫": r"\gg ",
    "≺": r"\prec ", "≻": r"\succ ", "⊂": r"\subset ", "⊃": r"\supset ", "⊆": r"\subseteq ", "⊇": r"\supseteq ",
    "⊕": r"\oplus ", "⊖": r"\ominus ", "⊗": r"\otimes ", "⊙": r"\odot ", "⊤": r"\top ", "⊥": r"\perp ",
    "⋄": r"\diamond ", "⋅": r"\cdot ", "⋆": r"\star ", "⌈": r"\lceil ", "⌉": r"\rceil ", "⌊": r"\lfloor ",
    "⌋": r"\rfloor ", "〈": r"\langle ", "〉": r"\rangle ",
}
LATIN_LIKE_CAPITALS = {
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Χ": "X",
}


def _greek_command(name: str, capital: bool) -> str | None:
    """LaTeX command of a Greek letter by its Unicode name; None if it is none."""
    if name in VARIANTS:
        return f"\\{VARIANTS[name]}"
    if name not in GREEK:
        return None
    plain = name.lower().replace("lamda", "lambda")
    return f"\\{plain.capitalize() if capital else plain}"


def _command(char: str) -> str | None:
    """LaTeX of a letter by its Unicode name; None if the name is of no style that has a command."""
    name = unicodedata.name(char, "")
    if found := PLAIN_GREEK_NAME.fullmatch(name):
        command = _greek_command(found[2], found[1] == "CAPITAL")
        return None if command is None else f"{command} "
    if not (found := STYLED_NAME.fullmatch(name)):
        return None
    style, size, letter = found.groups()
    if size and len(letter) == 1:
        inner = letter if size == "CAPITAL" else letter.lower()
        return None if style == "SCRIPT" and size == "SMALL" else f"\\{COMMANDS[style]}{{{inner}}}"
    inner = _greek_command(letter, size == "CAPITAL") if style in ("BOLD", "ITALIC", "BOLD ITALIC") else None
    return None if inner is None else f"\\{COMMANDS[style]}{{{inner}}}"


@cache
def unicode_symbols() -> dict[str, str]:
    """Character to LaTeX: spaces, Greek, and the styled mathematical alphabets, by their Unicode names."""
    found = {chr(i): _command(chr(i)) for low, high in RANGES for i in range(low, high)}
    return {char: tex for char, tex in found.items() if tex is not None} | SINGLES


def entity_symbols() -> dict[str, str]:
    """Character to LaTeX in formulas; Greek capitals that look Latin become upright letters."""
    greek = {c: tex for c, tex in unicode_symbols().items() if unicodedata.name(c).startswith("GREEK")}
    out = {c: f"{{\\rm {LATIN_LIKE_CAPITALS[c]}}}" if c in LATIN_LIKE_CAPITALS else tex for c, tex in greek.items()}
    return OPERATORS | out


def map_symbols(text: Column, symbols: Mapping[str, str], pattern: str = r"[^\x{00}-\x{7f}]") -> Column:
    """Replace the characters that the table has; looks up each distinct character of a text once."""
    # One literal that is folded to a constant map, instead of two literals per entry.
    pairs = "\u0001".join(f"{char}\u0002{tex}" for char, tex in symbols.items())
    table = F.str_to_map(F.lit(pairs), F.lit("\u0001"), F.lit("\u0002"))
    return replace_each(text, pattern, lambda c: F.try_element_at(table, c))


def unicode_to_latex(text: Column, symbols: Mapping[str, str] | None = None) -> Column:
    """Symbols to LaTeX, colour commands dropped, blanks and display brackets tidied."""
    out = map_symbols(text, symbols or unicode_symbols())
    out = F.regexp_replace(out, r"\\textcolor\[rgb\]\{[0-9.,]+\}", "")
    out = F.replace(out, F.lit("\\ ~\\ "), F.lit(r"{\sim}"))
    out = F.regexp_replace(out, r"^\$ ", r"\$")
    out = F.replace(out, F.lit("{\\ }"), F.lit("\\ "))
    out = F.replace(out, F.lit(" }"), F.lit("}"))
    out = F.replace(out, F.lit("\n\\[\n\t"), F.lit("$$"))
    return F.replace(out, F.lit("\n\\]"), F.lit("$$"))


def entity_to_latex(text: Column, symbols: Mapping[str, str] | None = None) -> Column:
    return map_symbols(text, symbols or entity_symbols())


def text_entity_to_latex(text: Column) -> Column:
    """Text inside a formula: spaces by width, special characters escaped, backslashes dropped."""
    out = F.replace(text, F.lit("\\"), F.lit(""))
    for char, tex in TEXT_ENTITIES.items():
        out = F.replace(out, F.lit(char), F.lit(tex))
    return out
