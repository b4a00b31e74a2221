"""Column-level helpers shared by all operators (native Spark expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must stay equal to the analysed tool's behaviour.
# ---------------------------------------------------------------------------
# Directory names pruned at any depth by the scanner and the code search.
SKIP_DIRS = ["venv", ".venv", "node_modules", ".git", "__pycache__", ".pytest_cache"]
# Directory names ignored by the dead-code scan (no cache folders here).
DEAD_CODE_SKIP_DIRS = ["node_modules", "venv", ".venv", ".git"]
# Suffixes with an outline (case-sensitive).
PARSEABLE_SUFFIXES = [".py", ".js", ".jsx"]
# Suffixes searched by search_code (compared lower-cased).
SEARCHABLE_SUFFIXES = [".py", ".js", ".jsx", ".ts", ".tsx", ".md", ".txt", ".json"]
# Suffixes counted by the churn heatmap (case-sensitive, via endswith).
CHURN_SUFFIXES = [".py", ".js", ".jsx", ".ts", ".tsx"]
# First N matching lines kept per file by search_code.
SEARCH_MATCH_CAP = 20
# Hotspots reported by the churn heatmap.
HOTSPOT_TOP_K = 15
# Outline line formats, fallback text, and risk bands (score > 5, > 10, > 20).
OUTLINE_DEF = "def {qualified}{params}  — lines {start}-{end}"
OUTLINE_CLASS = "class {name}  — lines {start}-{end}"
NO_SYMBOLS_TEXT = "No functions or classes found."
UNSUPPORTED_TEXT = "Error: Unsupported file type '{ext}'."
NOT_FOUND_TEXT = "Error: file not found at '{path}'."
NOT_A_FILE_TEXT = "Error: '{path}' is not a file."
NO_FUNCTION_TEXT = "Error: no function named '{name}' found in '{path}'."
SEARCH_LINE = "Line {n}: {text}"
RISK_BANDS = [(20, "Extreme"), (10, "High"), (5, "Moderate")]
RISK_DEFAULT = "Low"
# ---------------------------------------------------------------------------

# Characters for which Python's str.isspace() is true (str.strip() removes them).
PY_WS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B)))
         + "\u2028\u2029\u202f\u205f\u3000")
# Line boundaries of str.splitlines().
LINE_SPLIT_RE = r"\r\n|[\n\r\x0B\f\x1C-\x1E\x{85}\x{2028}\x{2029}]"
# Physical lines as counted by iterating a text-mode file (universal newlines).
UNIVERSAL_NEWLINE_RE = r"\r\n|\r|\n"
# A maximal run of word characters (a whole word for \b...\b).
WORD_RE = r"[\p{L}\p{N}_]+"


def template(fmt: str, **cols: Column) -> Column:
    """A fixed text format with ``{name}`` fields filled from columns."""
    import re
    parts = []
    for i, piece in enumerate(re.split(r"\{(\w+)\}", fmt)):
        if i % 2:
            parts.append(cols[piece].cast("string"))
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts)


def py_strip(col: Column) -> Column:
    """Python ``str.strip()``: remove leading and trailing Unicode whitespace."""
    return F.btrim(col, F.lit(PY_WS))


def split_lines(content: Column) -> Column:
    """``str.splitlines()`` as an array column (no empty tail element)."""
    parts = F.split(content, LINE_SPLIT_RE, -1)
    return F.when(F.element_at(parts, -1) == F.lit(""),
                  F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def suffix(path: Column) -> Column:
    """``PurePosixPath(path).suffix``: '' for '.py', 'a.', or no dot."""
    return F.regexp_extract(file_name(path), r"^.+(\.[^.]+)$", 1)


def classify_language(path: Column) -> Column:
    """Suffix -> 'python' / 'javascript'; null when unsupported."""
    ext = suffix(path)
    return (F.when(ext == ".py", F.lit("python"))
            .when(ext.isin(".js", ".jsx"), F.lit("javascript")))


def dir_parts(path: Column) -> Column:
    """Directory components of a relative path (file name excluded)."""
    parts = F.split(path, "/")
    return F.slice(parts, 1, F.size(parts) - 1)


def in_skipped_dir(path: Column, skip=SKIP_DIRS, prefix: str | None = None) -> Column:
    """True when a directory component *below the scope* is an ignored name
    (the scope's own path may contain one: pruning starts below it)."""
    if prefix not in (None, "", "."):
        path = F.substring(path, F.lit(len(prefix.strip("/")) + 2), F.length(path))
    return F.arrays_overlap(dir_parts(path), F.array(*[F.lit(s) for s in skip]))


def scope(path: Column, prefix: str | None) -> Column:
    """Subtree restriction ('.' or '' means the whole repository)."""
    if prefix in (None, "", "."):
        return F.lit(True)
    prefix = prefix.strip("/")
    return path.startswith(prefix + "/")


def loc(content: Column) -> Column:
    """Physical lines (universal newlines; an unterminated tail counts; '' is 0)."""
    breaks = F.size(F.split(content, UNIVERSAL_NEWLINE_RE, -1)) - 1
    tail = F.when((F.length(content) > 0) & ~content.rlike(r"[\r\n]\z"), 1).otherwise(0)
    return (breaks + tail).cast("bigint")


def decode_text(raw: Column) -> Column:
    """Bytes -> text: UTF-16 when the data starts with a byte-order mark
    (FF FE or FE FF), has an even length and no unpaired surrogate, else
    UTF-8 with U+FFFD for invalid sequences."""
    head = F.substring(raw, 1, 2)
    is_bom = head.isin(F.lit(bytes([0xFF, 0xFE])), F.lit(bytes([0xFE, 0xFF])))
    utf16 = F.decode(raw, "UTF-16")
    utf8 = F.make_valid_utf8(raw.cast("string"))
    # Each unit's high byte: a leading surrogate (D8-DB) must be followed by a trailing one (DC-DF).
    units = F.hex(F.substring(raw, F.lit(3), F.length(raw)))
    little = head == F.lit(bytes([0xFF, 0xFE]))
    one = F.when(little, F.lit("..(?!D[89A-F])..")).otherwise(F.lit("(?!D[89A-F])...."))
    pair = F.when(little, F.lit("..D[89AB]..D[C-F]")).otherwise(F.lit("D[89AB]..D[C-F].."))
    paired = F.regexp(units, F.concat(F.lit("^(?:"), one, F.lit("|"), pair, F.lit(")*+$")))
    return F.when(is_bom & (F.length(raw) % 2 == 0) & paired, utf16).otherwise(utf8)


def strict_utf8(raw: Column) -> Column:
    """Strict UTF-8: the text, or null for undecodable bytes."""
    return F.try_validate_utf8(raw.cast("string"))


def doc_summary(doc: Column) -> Column:
    """First non-blank docstring line, '...' appended when more follow."""
    s = py_strip(doc)
    s = F.regexp_replace(s, r'\A"+|"+\z', "")
    s = F.regexp_replace(s, r"\A'+|'+\z", "")
    lines = F.filter(F.transform(F.split(s, "\n", -1), py_strip), lambda x: x != F.lit(""))
    return (F.when(F.size(lines) == 0, F.lit(""))
            .when(F.size(lines) > 1, F.concat(F.element_at(lines, 1), F.lit("...")))
            .otherwise(F.element_at(lines, 1)))


def risk_level(score: Column) -> Column:
    expr = None
    for bound, name in RISK_BANDS:
        expr = F.when(score > bound, F.lit(name)) if expr is None else expr.when(score > bound, F.lit(name))
    return expr.otherwise(F.lit(RISK_DEFAULT))


def qualify(class_name: Column, name: Column) -> Column:
    """'Class.name' or 'name'."""
    return F.concat_ws(".", class_name, name)
