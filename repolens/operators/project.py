"""What a project is built with: frameworks, dependencies, config and CI files.

Only each repository's top directory is inspected (plus
``.github/workflows/*.yml``).  Every top-level file contributes its facts
row-locally -- npm keys, pip lines, env keys, matched signals and
candidate positions -- and one ``groupBy(repo)`` assembles the profile.
The signal and candidate tables are fixed and tiny, so their joins are
evaluated against literal arrays inside the row (a broadcast in all but
name): the file table is scanned once and shuffled once, with rows that
are already reduced to a few strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repolens.functions.text import decode_text, py_strip, split_lines

# ---------------------------------------------------------------------------
# Fixed values (must match the analysed tool).
# ---------------------------------------------------------------------------
# (manifest, signal, framework)
FRAMEWORK_SIGNALS = [
    ("package.json", "next", "Next.js"), ("package.json", "react", "React"),
    ("package.json", "vue", "Vue"), ("package.json", "express", "Express"),
    ("package.json", "@angular/core", "Angular"),
    ("requirements.txt", "flask", "Flask"), ("requirements.txt", "django", "Django"),
    ("requirements.txt", "fastapi", "FastAPI"),
    ("pyproject.toml", "flask", "Flask"), ("pyproject.toml", "django", "Django"),
    ("pyproject.toml", "fastapi", "FastAPI"),
]
# File whose mere presence names a framework.
PRESENCE_FRAMEWORKS = [("manage.py", "Django"), ("next.config.js", "Next.js"), ("next.config.ts", "Next.js")]
CONFIG_FILE_CANDIDATES = [
    ".env.example", ".env", "docker-compose.yml", "pytest.ini",
    "tsconfig.json", ".eslintrc.json", ".eslintrc.js", ".prettierrc",
    "vite.config.js", "vite.config.ts", "next.config.js", "next.config.ts",
    "tailwind.config.js",
]
BUILD_CI_CANDIDATES = ["Makefile", "Dockerfile", ".gitlab-ci.yml"]
WORKFLOW_RE = r"^\.github/workflows/[^/]+\.yml$"
# ---------------------------------------------------------------------------


def _lit_table(rows, names) -> Column:
    return F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(r, names)]) for r in rows])


def npm_keys(content: Column) -> Column:
    """dependencies then devDependencies keys, first position wins; null when
    the manifest is not a JSON object throughout, or either is no object
    (such errors are swallowed; ``npm_problem`` names them)."""
    deps, dev = _json_member(content, "dependencies"), _json_member(content, "devDependencies")
    no_keys = F.array().cast("array<string>")
    return F.when(npm_problem(content).isNull(), F.array_union(F.coalesce(F.json_object_keys(deps), no_keys), F.coalesce(F.json_object_keys(dev), no_keys)))


def _json_member(content: Column, name: str) -> Column:
    return F.get_json_object(content, f"$.{name}")


def npm_problem(content: Column) -> Column:
    """What is wrong with a package.json; null when nothing is."""
    is_object = lambda x: F.coalesce(x.rlike(r"\A\s*\{"), F.lit(True))
    # as the one member of an array: nothing may follow the value
    whole = F.json_array_length(F.concat(F.lit("["), content, F.lit("]"))) == 1
    return (F.when(~F.coalesce(whole, F.lit(False)) | ~is_object(content), F.lit("not a JSON object"))
            .when(~(is_object(_json_member(content, "dependencies")) & is_object(_json_member(content, "devDependencies"))),
                  F.lit("dependencies are not an object")))


def pip_lines(content: Column) -> Column:
    """requirements.txt: lower-cased, non-blank lines not starting '#'
    (tested before stripping), stripped."""
    lines = split_lines(F.lower(content))
    return F.transform(F.filter(lines, lambda x: (py_strip(x) != "") & ~x.startswith("#")), py_strip)


def env_keys(content: Column) -> Column:
    """.env.example: text before the first '=' of each stripped, non-comment
    line holding '='; order and duplicates kept."""
    lines = F.transform(split_lines(content), py_strip)
    keep = F.filter(lines, lambda x: (x != "") & ~x.startswith("#") & x.contains("="))
    return F.transform(keep, lambda x: py_strip(F.split_part(x, F.lit("="), F.lit(1))))


def dependency_signal_join(keys: Column) -> Column:
    """npm dependency key = signal -> framework (equi join with a fixed table)."""
    table = _lit_table([r for r in FRAMEWORK_SIGNALS if r[0] == "package.json"], ["m", "signal", "fw"])
    hits = F.filter(table, lambda s: F.array_contains(F.coalesce(keys, F.array().cast("array<string>")), s["signal"]))
    return F.transform(hits, lambda s: s["fw"])


def text_signal_join(path: Column, lowered: Column) -> Column:
    """Lower-cased manifest text contains signal -> framework (theta join)."""
    table = _lit_table([r for r in FRAMEWORK_SIGNALS if r[0] != "package.json"], ["m", "signal", "fw"])
    hits = F.filter(table, lambda s: (s["m"] == path) & lowered.contains(s["signal"]))
    return F.transform(hits, lambda s: s["fw"])


def presence_join(path: Column, candidates: list[str]) -> Column:
    """1-based position of the file in the candidate list (0 when absent)."""
    return F.array_position(F.array(*[F.lit(c) for c in candidates]), path)


def project_facts(files: DataFrame) -> DataFrame:
    """One row per top-level file with everything it contributes.

    With a ``raw`` binary column the manifests are decoded here (BOM-aware
    UTF-16, else UTF-8 with replacement); otherwise ``content`` is used.
    """
    path = F.col("path")
    content = decode_text(F.col("raw")) if "raw" in files.columns else F.col("content")
    top = files.where(~path.contains("/") | path.rlike(WORKFLOW_RE))
    presence = _lit_table(PRESENCE_FRAMEWORKS, ["name", "fw"])
    is_pkg, is_req, is_env = path == "package.json", path == "requirements.txt", path == ".env.example"
    npm = F.when(is_pkg, npm_keys(content))
    frameworks = F.concat(
        dependency_signal_join(npm),
        F.when(path.isin("requirements.txt", "pyproject.toml"), text_signal_join(path, F.lower(content)))
        .otherwise(F.array().cast("array<string>")),
        F.transform(F.filter(presence, lambda p: p["name"] == path), lambda p: p["fw"]))
    build_pos = presence_join(path, BUILD_CI_CANDIDATES)
    return top.select(
        "repo", "path",
        npm.alias("npm"),
        F.when(is_pkg, npm_problem(content)).alias("problem"),
        F.when(is_req, pip_lines(content)).alias("pip"),
        F.when(is_env, env_keys(content)).alias("env"),
        frameworks.alias("frameworks"),
        presence_join(path, CONFIG_FILE_CANDIDATES).alias("config_pos"),
        F.when(build_pos > 0, build_pos).when(path.rlike(WORKFLOW_RE), F.lit(len(BUILD_CI_CANDIDATES) + 1))
        .otherwise(0).alias("build_pos"))


def project_config(files: DataFrame) -> DataFrame:
    """Per repository: frameworks (sorted), npm / pip dependency lists (null
    when that manifest is absent), config files and build/CI files (fixed
    list order, then workflows by name), expected env vars (file order), and
    what is wrong with its package.json, if anything (``problem``)."""
    facts = project_facts(files)
    # only rows that contribute something reach the per-repo group, so a
    # repository's group is bounded by its manifests and candidate files
    facts = facts.where(F.col("npm").isNotNull() | F.col("pip").isNotNull() | F.col("env").isNotNull()
                        | (F.size("frameworks") > 0) | (F.col("config_pos") > 0) | (F.col("build_pos") > 0)
                        | F.col("path").isin("package.json", "requirements.txt", ".env.example"))
    ordered = lambda pos: F.transform(
        F.sort_array(F.collect_list(F.when(F.col(pos) > 0, F.struct(F.col(pos).alias("k"), F.col("path").alias("v"))))),
        lambda x: x["v"])
    prof = facts.groupBy("repo").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("frameworks")))).alias("frameworks"),
        F.first("npm", ignorenulls=True).alias("npm"),
        F.first("problem", ignorenulls=True).alias("problem"),
        F.first("pip", ignorenulls=True).alias("pip"),
        ordered("config_pos").alias("config_files"),
        ordered("build_pos").alias("build_ci"),
        F.coalesce(F.first("env", ignorenulls=True), F.array().cast("array<string>")).alias("env_vars_expected"))
    # every repository gets a profile, also one whose top level has no signal
    # (the distinct repo list reads only the repo column)
    empty = F.array().cast("array<string>")
    prof = files.select("repo").distinct().join(prof, "repo", "left").select(
        "repo", F.coalesce("frameworks", empty).alias("frameworks"), "npm", "pip", "problem",
        F.coalesce("config_files", empty).alias("config_files"), F.coalesce("build_ci", empty).alias("build_ci"),
        F.coalesce("env_vars_expected", empty).alias("env_vars_expected"))
    deps = F.map_filter(F.map_from_arrays(F.array(F.lit("npm"), F.lit("pip")), F.array("npm", "pip")),
                        lambda k, v: v.isNotNull())
    return prof.withColumn("dependencies", deps)
