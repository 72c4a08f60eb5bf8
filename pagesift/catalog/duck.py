"""Pieces of DuckDB SQL, written apart from the Spark expressions they check."""

from __future__ import annotations

SPACE = r"[\s\p{Z}\x{1c}-\x{1f}\x{85}]"
NOT_ALNUM_NOR_SPACE = r"[^\p{L}\p{N}\s\p{Z}\x{1c}-\x{1f}\x{85}]"


def q(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def rx(text: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({text}, {q(pattern)}, {q(to)}, 'g')"


def rep(text: str, old: str, new: str) -> str:
    return f"replace({text}, {q(old)}, {q(new)})"


def one_line(text: str) -> str:
    return f"trim({rx(text, SPACE + '+', ' ')})"


def simplify(text: str, punctuation: bool = False) -> str:
    lower = f"lower({text})"
    return one_line(lower if punctuation else rx(lower, NOT_ALNUM_NOR_SPACE))


def split_blanks(text: str) -> str:
    return f"list_filter(string_split({text}, ' '), lambda w_: w_ <> '')"


def words(text: str, punctuation: bool = False) -> str:
    return split_blanks(simplify(text, punctuation))


def ngrams(tokens: str, n: int) -> str:
    """Of a column that holds tokens."""
    return (
        f"CASE WHEN len({tokens}) >= {n} THEN list_transform(range(1, len({tokens}) - {n} + 2), "
        f"lambda i_: array_to_string({tokens}[i_:i_ + {n - 1}], ' ')) ELSE [] END"
    )


def overlap(query: str, label: str, n: int) -> str:
    first, last = f"greatest(1, {n} - len({query}))", f"least({n - 1}, len({label}))"
    return (
        f"CASE WHEN {first} <= {last} THEN list_transform(range({first}, {last} + 1), lambda k_: "
        f"array_to_string(list_concat({query}[len({query}) - ({n} - k_) + 1:], {label}[1:k_]), ' ')) ELSE [] END"
    )


def md5_31(text: str) -> str:
    return f"(('0x' || substr(md5({text}), 1, 8))::BIGINT % 2147483647)"


HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:\[\]@\s]+)"


def host(url: str) -> str:
    return f"nullif(rtrim(lower(regexp_extract({url}, {q(HOST)}, 1)), '.'), '')"


def registered_domain(host_col: str) -> str:
    """For hosts under com, net and org."""
    return (
        f"CASE WHEN regexp_matches({host_col}, '^[0-9]{{1,3}}([.][0-9]{{1,3}}){{3}}$') THEN NULL "
        f"ELSE nullif(regexp_extract({host_col}, '([^.]+[.](com|net|org))$', 1), '') END"
    )


NAMED = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "copy": "©", "middot": "·"}
REFERENCE = "&(#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*);"


def decode_ctes(source: str, columns: str, prefix: str, text: str = "t") -> str:
    """CTE chain from ``source`` to ``<prefix>4`` whose column ``t`` has its character references decoded.

    Knows the names that the test pages use.
    """
    named = " ".join(f"WHEN '&{name};' THEN {q(char)}" for name, char in NAMED.items())
    number = (
        "CASE WHEN regexp_matches(e_, '^&#0*[0-9]{1,7};$') THEN regexp_extract(e_, '[0-9]+')::INT "
        "WHEN regexp_matches(e_, '^&#[xX]0*[0-9a-fA-F]{1,6};$') THEN ('0x' || regexp_extract(e_, '[xX]0*([0-9a-fA-F]+)', 1))::INT END"
    )
    valid = f"(({number} > 0 AND {number} < 55296) OR ({number} > 57343 AND {number} <= 1114111))"
    char = f"CASE e_ {named} ELSE CASE WHEN {valid} THEN chr({number}) ELSE e_ END END"
    return (
        f"{prefix}1 AS (SELECT {columns}, {text} AS t FROM {source}), "
        f"{prefix}2 AS (SELECT {columns}, string_split_regex(t, {q(REFERENCE)}) AS gaps, "
        f"list_transform(regexp_extract_all(t, {q(REFERENCE)}), lambda e_: {char}) AS found FROM {prefix}1), "
        f"{prefix}4 AS (SELECT {columns}, array_to_string(list_transform(range(1, len(gaps) + 1), "
        f"lambda i_: gaps[i_] || coalesce(found[i_], '')), '') AS t FROM {prefix}2)"
    )


INVISIBLE = ("head", "script", "style", "noscript", "template")
BLOCKS = (
    "address|article|aside|blockquote|body|br|caption|dd|div|dl|dt|fieldset|figcaption|figure|footer"
    "|form|h[1-6]|header|hr|html|li|main|nav|ol|option|p|pre|section|select|table|tbody|tfoot|thead|title|tr|ul"
)


def visible_markup(html: str) -> str:
    out = rx(html, "(?s)<!--.*?-->")
    for tag in INVISIBLE:
        out = rx(out, rf"(?is)<{tag}(\s[^>]*)?>.*?</{tag}\s*>")
    out = rx(out, r"[ \t\r\n\f]+", " ")
    out = rx(out, rf"(?i)</?({BLOCKS})([\s/][^>]*)?>", "\n")
    out = rx(out, r"(?i)</t[dh]\s*>", "\t")
    return rx(out, "<[a-zA-Z/!?][^>]*>")


def tidy(text: str) -> str:
    out = rx(text, r"[ \x{a0}]+", " ")
    out = rx(out, r" *\n[ \t\n]*", "\n")
    return rx(out, r"^[ \t\n]+|[ \t\n]+$")


def extract_text_ctes(source: str, columns: str, html: str = "html", out: str = "extracted") -> str:
    """CTE chain ending in ``<out>`` with the columns and ``text``."""
    return (
        f"{out}0 AS (SELECT {columns}, {visible_markup(html)} AS t FROM {source}), "
        f"{decode_ctes(out + '0', columns, out)}, "
        f"{out} AS (SELECT {columns}, {tidy('t')} AS text FROM {out}4)"
    )
