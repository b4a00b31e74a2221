"""Symbols (functions, methods, classes) with spans, names and complexity.

Python: a definition is a logical line whose first significant token is
``def`` / ``async def`` / ``class``.  Its span ends at the last significant
line before the next logical line indented no deeper (decorators stay
outside, ``async`` inside).  The enclosing class is the innermost open
class at a shallower indent, looking through functions.

Both questions are answered in linear time per file with the *level*
method: every logical line is copied to each definition indent ``v`` of
its file that it closes (its indent <= v), and every definition is copied
to each shallower level as a lookup row.  In a window over
``(repo, path, v)`` ordered by logical line, the nearest following closer
gives the span end and the nearest preceding closer tells whether a class
at level ``v`` is open.  No self-join, no pairs.

Cyclomatic complexity comes out of the same pass: decisions per logical
line are summed into a running prefix, so the decisions inside a span are
``prefix(end) - prefix(start)`` -- nested functions count for every
function around them, as in a subtree query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repolens.functions.text import NO_FUNCTION_TEXT, NO_SYMBOLS_TEXT, OUTLINE_CLASS, OUTLINE_DEF, classify_language, py_strip, qualify, template
from repolens.operators import tokens as T

_FILE = ["repo", "path"]

# Statement keywords that add a path when they open a logical line.
DECISION_KEYWORDS = ["if", "for", "while", "except", "with"]


def _decisions(ll: DataFrame) -> Column:
    t1, t2 = F.col("t1"), F.col("t2")
    kw = (t1.isin(*DECISION_KEYWORDS)
          | ((t1 == "async") & t2.isin("for", "with"))
          | ((t1 == "case") & F.col("colon_off").isNotNull()
             & ~F.coalesce(t2, F.lit(":")).isin("=", ".", ",", ")", ":")))
    return F.when(kw, 1).otherwise(0) + F.col("n_andor") + F.col("n_else")


def python_symbols_from_lines(ll: DataFrame) -> DataFrame:
    """Logical lines -> python symbols with spans, class names, decisions."""
    t1, t2, t3 = F.col("t1"), F.col("t2"), F.col("t3")
    is_async = (t1 == "async") & (t2 == "def")
    kind = F.when((t1 == "def") | is_async, F.lit("def")).when(t1 == "class", F.lit("class"))
    name = F.when(is_async, t3).otherwise(t2)

    w = Window.partitionBy(*_FILE).orderBy("ll")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    lines = ll.select("*", kind.alias("kind"), name.alias("name"), _decisions(ll).alias("dec"))
    lines = lines.select(
        "*",
        F.lag("last_line").over(w).alias("prev_last_line"),
        F.lag("end_off").over(w).alias("prev_end_off"),
        F.coalesce(F.sum("dec").over(before), F.lit(0)).alias("cum_dec"),
        F.max("last_line").over(whole).alias("file_last_line"),
        F.max("end_off").over(whole).alias("file_end_off"),
        F.sum("dec").over(whole).alias("file_dec"),
        F.collect_set(F.when(F.col("kind").isNotNull(), F.col("indent"))).over(whole).alias("levels"),
        F.lead("t1").over(w).alias("nx_t1"),
        F.lead("n_sig").over(w).alias("nx_nsig"),
        F.lead("indent").over(w).alias("nx_indent"),
        F.lead("first_off").over(w).alias("nx_first_off"),
        F.lead("end_off").over(w).alias("nx_end_off"))

    indent, is_sym = F.col("indent"), F.col("kind").isNotNull()
    header_ends_with_colon = F.col("end_off") == F.col("colon_off") + 1
    has_doc = (header_ends_with_colon & (F.col("nx_nsig") == 1) & (F.col("nx_indent") > indent)
               & F.col("nx_t1").rlike(T.STRING_START))
    on_line = F.coalesce(F.col("alone.colon") == F.col("colon_off"), F.lit(False))
    # only definitions carry their columns on; the other lines close and open levels
    head_info = F.when(is_sym, F.struct(
        "first_pos", "first_off", "start_line", "open_off", "close_off", "colon_off", "arrow_off",
        F.when(has_doc, F.col("nx_first_off")).when(on_line, F.col("alone.off")).alias("doc_off"),
        F.when(has_doc, F.col("nx_end_off")).when(on_line, F.col("alone.end")).alias("doc_end_off"),
        "file_last_line", "file_end_off", "file_dec"))
    exploded = lines.select(
        *_FILE, "ll", "indent", "kind", "name", "prev_last_line", "prev_end_off", "cum_dec", head_info.alias("h"),
        F.explode(F.filter("levels", lambda v: (v >= indent) | ((F.col("kind") == "def") & (v < indent)))).alias("v"))
    is_closer = F.col("indent") <= F.col("v")
    closer_info = F.struct(F.col("prev_last_line").alias("last_line"),
                           F.col("prev_end_off").alias("end_off"),
                           F.col("cum_dec").alias("cum_dec"))
    open_info = F.struct(((F.col("kind") == "class") & (F.col("indent") == F.col("v"))).alias("is_class"),
                         F.col("name").alias("name"))
    exploded = exploded.select("*", F.when(is_closer, closer_info).alias("closer"))
    fwd = Window.partitionBy(*_FILE, "v").orderBy("ll").rowsBetween(Window.unboundedPreceding, -1)
    exploded = exploded.select(
        "*", F.last(F.when(is_closer, open_info), ignorenulls=True).over(fwd).alias("open"),
        F.expr(f"lead(closer) IGNORE NULLS OVER (PARTITION BY {', '.join(_FILE)}, v ORDER BY ll)").alias("nxt"))

    head = is_sym & (F.col("indent") == F.col("v"))
    lookup = ~is_closer
    enclosing = F.when(lookup & F.col("open.is_class"), F.col("open.name"))
    rows = exploded.where(head | (lookup & F.col("open.is_class")))
    span = F.struct(
        F.coalesce(F.col("nxt.last_line"), F.col("h.file_last_line")).alias("end_line"),
        F.coalesce(F.col("nxt.end_off"), F.col("h.file_end_off")).alias("end_off"),
        (F.coalesce(F.col("nxt.cum_dec"), F.col("h.file_dec")) - F.col("cum_dec")).alias("decisions"))
    grouped = rows.groupBy(*_FILE, "ll").agg(
        F.first(F.when(head, F.struct("kind", "name", "h.*")), ignorenulls=True).alias("h"),
        F.first(F.when(head, span), ignorenulls=True).alias("s"),
        F.max_by(enclosing, F.when(enclosing.isNotNull(), F.col("v"))).alias("class_name"))

    h = lambda c: F.col(f"h.{c}")
    return grouped.where(F.col("h").isNotNull()).select(
        *_FILE,
        F.lit("python").alias("lang"),
        h("kind").alias("kind"),
        h("name").alias("name"),
        F.when(h("kind") == "def", F.col("class_name")).alias("class_name"),
        h("start_line").cast("int").alias("start_line"),
        F.col("s.end_line").cast("int").alias("end_line"),
        h("first_pos").alias("start_pos"),
        h("first_off").alias("start_off"),
        F.col("s.end_off").alias("end_off"),
        *[h(c).alias(c) for c in ("open_off", "close_off", "arrow_off", "colon_off", "doc_off", "doc_end_off")],
        (F.col("s.decisions") + 1).cast("int").alias("complexity"),
    )


def python_symbols(files: DataFrame, partitioned: bool = False) -> DataFrame:
    """files -> symbol offsets (text columns are attached by ``with_text``)."""
    py = files.where(classify_language(F.col("path")) == "python")
    return python_symbols_from_lines(T.logical_lines(T.tokenize(py, "python", partitioned=partitioned)))


def python_spans(files: DataFrame) -> DataFrame:
    """Python symbols with qualified names and spans, without text columns.

    For analyses that need names, spans and scores only (change impact,
    complexity, dead code): no JavaScript pass and no join back to the
    file text.
    """
    syms = python_symbols(files)
    return syms.withColumn("qualified_name", qualify(F.col("class_name"), F.col("name")))


def with_text(symbols: DataFrame, files: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """Attach params, return type, docstring and source by offset slicing.

    One equi-join on (repo, path) against the same partitioned files, whose
    columns ``more`` are kept too.
    """
    content = F.col("content")

    def cut(start: Column, end: Column) -> Column:  # [start, end) 0-based offsets
        return F.substring(content, (start + 1).cast("int"), (end - start).cast("int"))

    params = F.when(F.col("kind") == "def",
                    F.coalesce(cut(F.col("open_off"), F.col("close_off") + 1), F.lit("()")))
    ret = F.when((F.col("kind") == "def") & F.col("arrow_off").isNotNull()
                 & (F.col("arrow_off") < F.col("colon_off")),
                 py_strip(cut(F.col("arrow_off") + 2, F.col("colon_off"))))
    doc = F.when(F.col("doc_off").isNotNull(), cut(F.col("doc_off"), F.col("doc_end_off")))
    joined = symbols.join(files.select(*_FILE, *more, "content"), _FILE, "inner")
    return joined.select(
        *_FILE, *more, "lang", "kind", "name", "class_name",
        qualify(F.col("class_name"), F.col("name")).alias("qualified_name"),
        params.alias("params"), ret.alias("return_type"), doc.alias("docstring"),
        "start_line", "end_line", "start_pos", "start_off", "end_off", "complexity",
        cut(F.col("start_off"), F.col("end_off")).alias("source"))


def extract_symbols(files: DataFrame) -> DataFrame:
    """files(repo, path, content) -> symbols for Python and JavaScript."""
    from repolens.operators import jssymbols  # noqa: F401
    files = T.partition_files(files)
    offsets = python_symbols(files, partitioned=True).unionByName(jssymbols.js_symbols(files, partitioned=True))
    # one join back to the (already partitioned) text for both languages
    return with_text(offsets, files)


def outline_line(kind: Column, qualified: Column, name: Column, params: Column,
                 start: Column, end: Column) -> Column:
    return F.when(kind == "def", template(OUTLINE_DEF, qualified=qualified, params=params, start=start, end=end)) \
        .otherwise(template(OUTLINE_CLASS, name=name, start=start, end=end))


def outline(files: DataFrame, symbols: DataFrame) -> DataFrame:
    """One rendered outline per parseable file (fallback text when empty).

    ``(repo, path, outline)``; lines in document order.
    """
    lines = symbols.select(*_FILE, "start_off", outline_line(
        F.col("kind"), F.col("qualified_name"), F.col("name"), F.col("params"),
        F.col("start_line"), F.col("end_line")).alias("line"))
    per_file = lines.groupBy(*_FILE).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("start_off", "line"))),
                                 lambda x: x["line"]), "\n").alias("outline"))
    parseable = files.where(classify_language(F.col("path")).isNotNull()).select(*_FILE)
    return (parseable.join(per_file, _FILE, "left")
            .select(*_FILE, F.coalesce("outline", F.lit(NO_SYMBOLS_TEXT)).alias("outline")))


def function_source(symbols: DataFrame, qualified_name: str | None = None, files: DataFrame | None = None) -> DataFrame:
    """Exact source of the first def with the given qualified name per file.

    With ``qualified_name=None`` every distinct qualified name of every file
    is answered: ``(repo, path, qualified_name, source)``.  With a name and
    ``files``, every parseable file answers: one without that def with the
    text that says so.
    """
    if qualified_name is not None and files is not None:
        found = function_source(symbols, qualified_name).select(*_FILE, "source")
        every = files.where(classify_language(F.col("path")).isNotNull()).select(*_FILE)
        missing = template(NO_FUNCTION_TEXT, name=F.lit(qualified_name), path=F.col("path"))
        return every.join(found, _FILE, "left").select(*_FILE, F.lit(qualified_name).alias("qualified_name"), F.coalesce("source", missing).alias("source"))
    defs = symbols.where(F.col("kind") == "def")
    if qualified_name is not None:
        defs = defs.where(F.col("qualified_name") == qualified_name)
    return (defs.groupBy(*_FILE, "qualified_name")
            .agg(F.min_by("source", "start_off").alias("source")))
