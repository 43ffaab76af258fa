"""Text scalar functions as native Spark column expressions (no Python UDFs).

Every function ``f(col) -> Column`` has a DuckDB twin ``f_sql(expr) -> str`` used by the oracle
queries; both spell the same regular expressions and character tables.

Regex dialects: Spark uses java.util.regex, DuckDB uses RE2. All patterns below stay inside the
common subset (no look-around, explicit ``\\x{..}`` code points, explicit whitespace classes).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour).
# Mathematical sans-serif bold letters A..Z start at U+1D5D4, a..z at U+1D5EE; bold digits 0..9
# that are mapped start at U+1D7EC (other matched digits stay unchanged).
# Mathematical sans-serif italic letters A..Z start at U+1D608, a..z at U+1D622.
BOLD_UPPER_START = 0x1D5D4
BOLD_LOWER_START = 0x1D5EE
BOLD_DIGIT_START = 0x1D7EC
ITALIC_UPPER_START = 0x1D608
ITALIC_LOWER_START = 0x1D622
# Runs of emoticons, pictographs, transport symbols, flags and three arrows become one space.
EMOJI_RUN = (r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}"
             r"\x{2193}\x{21B3}\x{2192}]+")
URL_PATTERN = r"https?://\S+|www\.\S+"
URL_PLACEHOLDER = "[URL]"
DATE_PATTERN = r"\b(?:\d{1,2}[-/]\d{1,2}[-/]\d{2,4}|\d{2,4}[-/]\d{1,2}[-/]\d{1,2})\b"
DATE_PLACEHOLDER = "[DATE]"
TIME_PATTERN = r"\b(?:\d{1,2}:\d{2}(?::\d{2})?\s?(?:AM|PM)?)\b"
TIME_PLACEHOLDER = "[TIME]"
HTML_TAG = r"<[^>]+>"
# Link test of channel messages; note "$-_" is a character range, kept as written.
LINK_PATTERN = r"http[s]?://(?:[a-zA-Z]|[0-9]|[$-_@.&+]|[!*\(\),]|(?:%[0-9a-fA-F][0-9a-fA-F]))+"
FIRST_SENTENCE_SPLIT = r"[.!?]|[\r\n]"
PROMPT_MAX_CHARS = 16384
QUESTION_SEPARATOR = "#next-question#"
DOCUMENT_SEPARATOR = "\n#next-document#\n"
CONTEXT_SEPARATOR = "/n"
# Own contracts for library helpers whose bodies are not in the reference:
#   quotes: curly single quotes -> ', curly double quotes -> ", "&apos;" -> '
SINGLE_QUOTES = "‘’‚‛"
DOUBLE_QUOTES = "“”„‟"
#   bullets removed at the start of a text by clean_full
BULLETS = r"[\x{2022}\x{2023}\x{2043}\x{2219}\x{25CB}\x{25CF}\x{25E6}\x{00B7}*]"
#   ASCII punctuation (Unicode category P) removed by clean_full
ASCII_PUNCT = r"""[!"#%&'()*,\-./:;?@\[\\\]_{}]"""
# Python str.strip() whitespace: every code point Python calls a space (a rule, not a list), for
# btrim/trim; and the same set as a regex class, spelled out so Java and RE2 agree.
PY_WS_CHARS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
PY_WS = (r"[\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}"
         r"\x{202F}\x{205F}\x{3000}]")


def _span(start: int, n: int) -> str:
    return "".join(chr(start + i) for i in range(n))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = _UPPER.lower()
_DIGITS = "0123456789"
BOLD_FROM = _span(BOLD_UPPER_START, 26) + _span(BOLD_LOWER_START, 26) + _span(BOLD_DIGIT_START, 10)
BOLD_TO = _UPPER + _LOWER + _DIGITS
ITALIC_FROM = _span(ITALIC_UPPER_START, 26) + _span(ITALIC_LOWER_START, 26)
ITALIC_TO = _UPPER + _LOWER


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _q(s: str) -> str:
    """A DuckDB string literal."""
    return "'" + s.replace("'", "''") + "'"


# ----------------------------------------------------------------------------- T1, T2
def unbold(c) -> Column:
    return F.translate(_c(c), BOLD_FROM, BOLD_TO)


def unbold_sql(e: str) -> str:
    return f"translate({e}, {_q(BOLD_FROM)}, {_q(BOLD_TO)})"


def unitalic(c) -> Column:
    return F.translate(_c(c), ITALIC_FROM, ITALIC_TO)


def unitalic_sql(e: str) -> str:
    return f"translate({e}, {_q(ITALIC_FROM)}, {_q(ITALIC_TO)})"


# ----------------------------------------------------------------------------- T3
def strip_emoji(c) -> Column:
    return F.regexp_replace(_c(c), EMOJI_RUN, " ")


def strip_emoji_sql(e: str) -> str:
    return f"regexp_replace({e}, {_q(EMOJI_RUN)}, ' ', 'g')"


# ----------------------------------------------------------------------------- T4
def mask_urls(c) -> Column:
    return F.regexp_replace(_c(c), URL_PATTERN, URL_PLACEHOLDER)


def mask_urls_sql(e: str) -> str:
    return f"regexp_replace({e}, {_q(URL_PATTERN)}, {_q(URL_PLACEHOLDER)}, 'g')"


# ----------------------------------------------------------------------------- T5
def ascii_only(c) -> Column:
    return F.regexp_replace(_c(c), r"[^\x{00}-\x{7F}]", "")


def ascii_only_sql(e: str) -> str:
    return f"regexp_replace({e}, '[^\\x{{00}}-\\x{{7F}}]', '', 'g')"


# ----------------------------------------------------------------------------- T6
def unicode_quotes(c) -> Column:
    x = F.translate(_c(c), SINGLE_QUOTES + DOUBLE_QUOTES, "'" * len(SINGLE_QUOTES) + '"' * len(DOUBLE_QUOTES))
    return F.replace(x, F.lit("&apos;"), F.lit("'"))


def unicode_quotes_sql(e: str) -> str:
    to = "'" * len(SINGLE_QUOTES) + '"' * len(DOUBLE_QUOTES)
    return f"replace(translate({e}, {_q(SINGLE_QUOTES + DOUBLE_QUOTES)}, {_q(to)}), '&apos;', '''')"


# ----------------------------------------------------------------------------- T7 (strip)
def py_strip(c) -> Column:
    """Python ``str.strip()``: remove whitespace at both ends (``btrim``, no regex scan)."""
    return F.btrim(_c(c), F.lit(PY_WS_CHARS))


def py_strip_sql(e: str) -> str:
    return f"trim({e}, {_q(PY_WS_CHARS)})"


# ----------------------------------------------------------------------------- T8
_CHAR_MAP_FROM = BOLD_FROM + ITALIC_FROM + SINGLE_QUOTES + DOUBLE_QUOTES
_CHAR_MAP_TO = BOLD_TO + ITALIC_TO + "'" * len(SINGLE_QUOTES) + '"' * len(DOUBLE_QUOTES)


def clean_text(c) -> Column:
    """unbold -> unitalic -> emoji runs -> strip -> quotes -> ASCII only -> URL mask.

    Same result as applying the steps in that order, computed faster: the three character maps
    (bold, italic, curly quotes) touch disjoint non-space, non-emoji characters, so they run as one
    ``translate`` pass; and a text whose byte length equals its character length is pure ASCII, so
    only the strip, ``&apos;`` and URL steps can change it."""
    c = _c(c)
    ascii_path = mask_urls(F.replace(py_strip(c), F.lit("&apos;"), F.lit("'")))
    x = F.translate(c, _CHAR_MAP_FROM, _CHAR_MAP_TO)
    x = strip_emoji(x)
    x = F.replace(py_strip(x), F.lit("&apos;"), F.lit("'"))
    full_path = mask_urls(ascii_only(x))
    return F.when(F.octet_length(c) == F.length(c), ascii_path).otherwise(full_path)


def clean_text_sql(e: str) -> str:
    x = unbold_sql(e)
    x = unitalic_sql(x)
    x = strip_emoji_sql(x)
    x = py_strip_sql(x)
    x = unicode_quotes_sql(x)
    x = ascii_only_sql(x)
    return mask_urls_sql(x)


# ----------------------------------------------------------------------------- T9 .. T12
def mask_dates(c) -> Column:
    return F.regexp_replace(_c(c), DATE_PATTERN, DATE_PLACEHOLDER)


def mask_dates_sql(e: str) -> str:
    return f"regexp_replace({e}, {_q(DATE_PATTERN)}, {_q(DATE_PLACEHOLDER)}, 'g')"


def mask_times(c) -> Column:
    return F.regexp_replace(_c(c), TIME_PATTERN, TIME_PLACEHOLDER)


def mask_times_sql(e: str) -> str:
    return f"regexp_replace({e}, {_q(TIME_PATTERN)}, {_q(TIME_PLACEHOLDER)}, 'g')"


def strip_tags(c) -> Column:
    return F.regexp_replace(_c(c), HTML_TAG, "")


def strip_tags_sql(e: str) -> str:
    return f"regexp_replace({e}, {_q(HTML_TAG)}, '', 'g')"


def norm_ws(c) -> Column:
    """Runs of white space (every code point Python counts as such) become one space; edges go."""
    return py_strip(F.regexp_replace(_c(c), PY_WS + "+", " "))


def norm_ws_sql(e: str) -> str:
    return py_strip_sql(f"regexp_replace({e}, {_q(PY_WS + '+')}, ' ', 'g')")


# ----------------------------------------------------------------------------- T13
def clean_full(c) -> Column:
    """lower, dashes -> space, [nbsp, newline] -> space, 2+ spaces -> one, leading bullet removed,
    strip, quotes, ASCII only, ASCII punctuation removed (own contract for the library parts)."""
    x = F.lower(_c(c))
    x = py_strip(F.regexp_replace(x, r"[-\x{2013}]", " "))
    x = F.regexp_replace(x, r"[\x{A0}\n]", " ")
    x = py_strip(F.regexp_replace(x, r"[ ]{2,}", " "))
    x = py_strip(F.regexp_replace(x, f"^{BULLETS}{PY_WS}*", ""))
    x = unicode_quotes(x)
    x = ascii_only(x)
    return F.regexp_replace(x, ASCII_PUNCT, "")


def clean_full_sql(e: str) -> str:
    x = f"lower({e})"
    x = py_strip_sql(f"regexp_replace({x}, '[-\\x{{2013}}]', ' ', 'g')")
    x = f"regexp_replace({x}, '[\\x{{A0}}\\n]', ' ', 'g')"
    x = py_strip_sql(f"regexp_replace({x}, '[ ]{{2,}}', ' ', 'g')")
    x = py_strip_sql(f"regexp_replace({x}, {_q('^' + BULLETS + PY_WS + '*')}, '', 'g')")
    x = unicode_quotes_sql(x)
    x = ascii_only_sql(x)
    return f"regexp_replace({x}, {_q(ASCII_PUNCT)}, '', 'g')"


# ----------------------------------------------------------------------------- T14 .. T17
def first_sentence(c) -> Column:
    return F.split(F.coalesce(_c(c), F.lit("")), FIRST_SENTENCE_SPLIT).getItem(0)


def first_sentence_sql(e: str) -> str:
    return f"regexp_split_to_array(coalesce({e}, ''), {_q(FIRST_SENTENCE_SPLIT)})[1]"


def has_links(c) -> Column:
    return _c(c).rlike(LINK_PATTERN)


def has_links_sql(e: str) -> str:
    return f"regexp_matches({e}, {_q(LINK_PATTERN)})"


def word_count(c) -> Column:
    return F.size(F.split(_c(c), " ")).cast("bigint")


def word_count_sql(e: str) -> str:
    return f"CAST(len(string_split({e}, ' ')) AS BIGINT)"


def truncate_prompt(c, n: int = PROMPT_MAX_CHARS) -> Column:
    return F.substring(_c(c), 1, n)


def truncate_prompt_sql(e: str, n: int = PROMPT_MAX_CHARS) -> str:
    return f"substring({e}, 1, {n})"


# ----------------------------------------------------------------------------- T18, T19, T24
def _regex_quote(s: str) -> str:
    out = []
    for ch in s:
        if ch == "\n":
            out.append(r"\n")
        elif ch.isalnum() or ch in " #-_/":
            out.append(ch)
        else:
            out.append("\\" + ch)
    return "".join(out)


def split_separator(c, sep: str = QUESTION_SEPARATOR) -> Column:
    """Split on a literal separator, strip each piece, drop empty pieces."""
    parts = F.split(_c(c), _regex_quote(sep))
    return F.filter(F.transform(parts, lambda x: py_strip(x)), lambda x: x != "")


def split_separator_sql(e: str, sep: str = QUESTION_SEPARATOR) -> str:
    return (f"list_filter(list_transform(string_split({e}, {_q(sep)}), lambda x: {py_strip_sql('x')}), "
            f"lambda x: x <> '')")


def join_passages(arr, sep: str = DOCUMENT_SEPARATOR) -> Column:
    """Strip passages, drop empty ones, join with the separator."""
    cleaned = F.filter(F.transform(_c(arr), lambda x: py_strip(x)), lambda x: x != "")
    return F.array_join(cleaned, sep)


def join_passages_sql(e: str, sep: str = DOCUMENT_SEPARATOR) -> str:
    return (f"array_to_string(list_filter(list_transform({e}, lambda x: {py_strip_sql('x')}), "
            f"lambda x: x <> ''), {_q(sep)})")


def split_lines(c) -> Column:
    return F.split(py_strip(c), "\n")


def split_lines_sql(e: str) -> str:
    return f"string_split({py_strip_sql(e)}, chr(10))"


# ----------------------------------------------------------------------------- T20
INSTRUCTION_SCHEMA = "array<struct<instruction:string,content:string>>"


def bracket_slice(c) -> Column:
    """Text from the first '[' to the last ']' inclusive; null when there is no such span."""
    c = _c(c)
    start = F.instr(c, "[")
    rpos = F.instr(F.reverse(c), "]")
    end = F.length(c) - rpos + 1
    return F.when((start > 0) & (rpos > 0) & (end >= start), c.substr(start, end - start + 1))


def json_array_extract(c) -> Column:
    return F.from_json(bracket_slice(c), INSTRUCTION_SCHEMA)


def bracket_slice_sql(e: str) -> str:
    start = f"instr({e}, '[')"
    rpos = f"instr(reverse({e}), ']')"
    end = f"(length({e}) - {rpos} + 1)"
    return (f"CASE WHEN {start} > 0 AND {rpos} > 0 AND {end} >= {start} "
            f"THEN substring({e}, {start}, {end} - {start} + 1) END")


def json_array_extract_sql(e: str) -> str:
    s = bracket_slice_sql(e)
    return (f"CASE WHEN json_valid({s}) AND json_type({s}) = 'ARRAY' THEN "
            f"from_json({s}, '[{{\"instruction\":\"VARCHAR\",\"content\":\"VARCHAR\"}}]') END")


# ----------------------------------------------------------------------------- T23
EVAL_CRITERIA = ("Relevance", "Coherence", "Conciseness")


def eval_score(c, criterion: str) -> Column:
    return F.regexp_extract(_c(c), f"{criterion} - (\\d)", 1).try_cast("int")


def eval_score_sql(e: str, criterion: str) -> str:
    return f"TRY_CAST(NULLIF(regexp_extract({e}, {_q(criterion + ' - (\\d)')}, 1), '') AS INTEGER)"
