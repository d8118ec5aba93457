import hashlib

import pytest
from pyspark.sql import functions as F

from tractloom.functions.canonical import hexdigest
from tractloom.operators import contracts
from tractloom.operators.checks import ConformanceError


def test_pinned_files(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"bytes")
    pin = lambda name, sha, n: spark.createDataFrame([(name, sha, n)], "name string, sha256 string, length long")
    right = hashlib.sha256(b"bytes").hexdigest()
    assert bytes(contracts.read_pinned(spark, str(tmp_path), pin("a.bin", right.upper(), 5)).first().content) == b"bytes"
    for wrong in (pin("a.bin", "00", 5), pin("a.bin", right, 4), pin("b.bin", right, 5)):
        with pytest.raises(Exception, match="SOURCE_CHECKSUM_MISMATCH"):
            contracts.read_pinned(spark, str(tmp_path), wrong).collect()


def test_projection_is_denied_by_default(spark):
    rows = spark.createDataFrame([(1, "m", "r", False, "x"), (2, "m", "r", None, "x"), (3, None, "r", False, "x"), (4, "m", "r", True, "x"), (5, "m", "r", False, "x")], "k int, market string, evidence_role string, quarantined boolean, secret string")
    policy = contracts.ProjectionPolicy(frozenset({"k"}), "m", "r")
    assert [r.k for r in contracts.project(rows, policy, ["k"], rows.where("k < 5").select("k"), "k").collect()] == [1]
    with pytest.raises(ConformanceError):
        contracts.project(rows, policy, ["k", "secret"], rows, "k")


def test_projection_fingerprint():
    contracts.require_projection(hexdigest(contracts.projection_parameters()))
    with pytest.raises(ConformanceError):
        contracts.require_projection("00")
