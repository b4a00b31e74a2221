"""repolens: source-code analytics as Spark DataFrame jobs.

Tables (all keyed by ``repo`` and ``path``):

* ``files(repo, path, content)`` -- one row per source file
* ``tokens`` -- lexical tokens with line, bracket depth and logical line
* ``symbols`` -- functions, methods and classes with spans
* ``hunks`` -- changed line ranges from unified diffs
* ``touches`` -- (repo, commit_id, path) from a git log

Every operator is a function ``DataFrame -> DataFrame`` built from native
Spark columns; Python only runs at the input edge (file listing and zip
expansion).
"""

from repolens.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
