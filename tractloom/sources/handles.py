"""Sources by opaque handle: a caller states the exact handle and kind, and a registry says where it lies.

The registry is two tables, roots (root_handle, root_path) and resources (handle, kind, root_handle, relative_path).
Resolving is a join of the wanted handles with them and gives each a path or the first rule it breaks. Nothing is listed
or searched, and paths with wildcards, `.` or `..` are refused, so no path leaves its root.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tractloom.operators import checks

LISTING = r"[*?\[\]{}]"


def within(path: Column, folder: str) -> Column:
    """Whether a path is the folder or lies in it."""
    top = folder.rstrip("/")
    return (F.rtrim(path, F.lit("/")) == top) | path.startswith(top + "/")


def relative_ok(path: Column) -> Column:
    """No absolute path, no scheme, no step to itself or upwards, no wildcard, no backslash."""
    steps = F.split(path, "/")
    return ~path.startswith("/") & ~path.contains(":") & ~path.contains("\\") & ~F.arrays_overlap(steps, F.array(F.lit("."), F.lit(".."))) & ~path.rlike(LISTING)


def root_violations(roots: DataFrame, repository: str) -> list[DataFrame]:
    """Roots have opaque names and absolute paths without steps upwards, outside the repository, each once."""
    p = F.col("root_path")
    absolute = p.startswith("/") | p.rlike("^[a-z][a-z0-9+]*:/")
    plain = F.regexp_replace(p, "^file:/+", "/")
    return [
        checks.where_not(roots, F.col("root_handle").startswith("proot-"), 1, "PROTECTED_ROOT_HANDLE_INVALID", F.col("root_handle")),
        checks.where_not(roots, absolute & ~F.arrays_overlap(F.split(p, "/"), F.array(F.lit("."), F.lit(".."))), 2, "PROTECTED_ROOT_PATH_INVALID", F.col("root_handle")),
        checks.where_not(roots, ~within(plain, repository), 3, "PROTECTED_ROOT_INSIDE_REPOSITORY", F.col("root_handle")),
        checks.duplicates(roots, ["root_handle"], 4, "PROTECTED_ROOT_HANDLE_INVALID"),
    ]


def authority_violations(authorities: DataFrame, request: DataFrame, roles: tuple[str, ...]) -> list[DataFrame]:
    """Each role has one workbook handle of its own, and the request asks for that one.

    authorities, request: source_role and workbook_handle.
    """
    wanted = authorities.sparkSession.createDataFrame([(r,) for r in roles], "source_role string")
    j = authorities.select("source_role", "workbook_handle").join(request.select("source_role", F.col("workbook_handle").alias("asked")), "source_role", "full")
    return [
        *checks.exact_cover(wanted, authorities, ["source_role"], 1, "TARGET_SOURCE_ROLE_DUPLICATE", "TARGET_SOURCE_ROLES_INCOMPLETE"),
        checks.where_not(authorities, F.col("workbook_handle").startswith("phandle-"), 3, "TARGET_SOURCE_HANDLE_INVALID", F.col("source_role")),
        checks.duplicates(authorities, ["workbook_handle"], 4, "TARGET_SOURCE_HANDLE_REUSED"),
        checks.where_not(j, F.col("workbook_handle") == F.col("asked"), 5, "TARGET_SOURCE_HANDLE_MISMATCH", F.col("source_role")),
    ]


def resolve(wanted: DataFrame, resources: DataFrame, roots: DataFrame) -> DataFrame:
    """handle, kind, path and code for each wanted (handle, kind): a path and no code, or no path and the rule it breaks.

    Nulls break the rule that reads them. A handle or root that is registered twice gives a row for each.
    """
    known = resources.select("handle", F.col("kind").alias("__kind"), F.col("root_handle").alias("__root"), F.col("relative_path").alias("__relative"), F.lit(True).alias("__known"))
    tops = roots.select(F.col("root_handle").alias("__root"), F.rtrim("root_path", F.lit("/")).alias("__top"))
    j = wanted.select("handle", "kind").join(known, "handle", "left").join(tops, "__root", "left")
    fails = lambda c: ~F.coalesce(c, F.lit(False))
    code = (
        F.when(fails(F.col("handle").startswith("phandle-")), "PROTECTED_HANDLE_INVALID")
        .when(F.col("__known").isNull(), "PROTECTED_HANDLE_UNRESOLVED")
        .when(fails(F.col("__kind") == F.col("kind")), "PROTECTED_HANDLE_KIND_MISMATCH")
        .when(F.col("__top").isNull(), "PROTECTED_ROOT_HANDLE_UNRESOLVED")
        .when(fails(F.col("__relative") != ""), "PROTECTED_RELATIVE_PATH_INVALID")
        .when(fails(relative_ok(F.col("__relative"))), "PROTECTED_PATH_TRAVERSAL_REJECTED")
    )
    return j.select("handle", "kind", F.when(code.isNull(), F.concat_ws("/", "__top", "__relative")).alias("path"), code.alias("code"))


def path_of(spark: SparkSession, handle: str, kind: str, resources: DataFrame, roots: DataFrame) -> str:
    """The path of one handle, for spark.read; raises the rule it breaks, or that nothing of that kind is there."""
    found = resolve(spark.createDataFrame([(handle, kind)], "handle string, kind string"), resources, roots).take(2)
    if found[0].code is not None or len(found) > 1:
        raise checks.ConformanceError(found[0].code or "PROTECTED_HANDLE_UNRESOLVED", handle)
    p = spark._jvm.org.apache.hadoop.fs.Path(found[0].path)
    files = p.getFileSystem(spark._jsc.hadoopConfiguration())
    folder = kind.endswith(("_directory", "_root"))
    if not files.exists(p) or files.getFileStatus(p).isDirectory() != folder:
        raise checks.ConformanceError("PROTECTED_DIRECTORY_UNRESOLVED" if folder else "PROTECTED_FILE_UNRESOLVED", handle)
    return found[0].path
