"""Document queries over whole tables against brute force."""

import hashlib
import re
import unicodedata
import uuid

import pytest

import __spark_entry__ as entry
from verify import duck, normal

TEXTS = [
    "plain words",
    None,
    "",
    "x" * 290 + " token = late-secret ; tail",
    "naïve café 中文 password: geheim, Ａ\u200bB",
    "é" * 350 + "\tBearer abc.DEF-1 and https://u:pw@host/p\x00q",
    " \n".join(["word"] * 400) + " api-key=z",
    " " * 600 + "secret:s3 e\u0301nd",
    "𝔘" * 600,
]


@pytest.fixture(scope="module")
def documents(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("documents"))
    rows = [(i, t, "en", "s", "a", None) for i, t in enumerate(TEXTS)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, sensor_id string, observed_at timestamp_ntz").write.parquet(root + "/documents.parquet")
    return root


def clean(text):
    t = "".join(c for c in text if unicodedata.category(c) not in ("Cc", "Cf"))
    t = re.sub(r"://[^/]*?:([^@/]+)@", "://[REDACTED]@", t)
    t = re.sub(r"((?:authorization\s*[:=]?\s*)?Bearer\s+)([A-Za-z0-9._\-]+)", r"\1[REDACTED]", t, flags=re.I | re.A)
    t = re.sub(r"(password|passwd|token|secret|api[-_]?key)\s*[:=]\s*([^\s,;]+)", r"\1=[REDACTED]", t, flags=re.I | re.A)
    return re.sub(r"\s+", " ", t, flags=re.A).strip(" ")[:512]


def test_whole_documents_are_sanitised(spark, documents):
    got = {r.doc_id: r.clean for r in entry.queries()["q47_sanitize_text"](spark, documents).collect()}
    assert got == {i: clean(f"failed at jdbc://user{i}:pw@db token={i} Bearer a.b-{i}\n{t or ''}") for i, t in enumerate(TEXTS)}
    assert "token=[REDACTED] ; tail" in got[3] and max(map(len, got.values())) == 512


def test_all_documents_get_digest_id_and_version(spark, documents):
    want = {}
    for i, t in enumerate(TEXTS):
        body = re.sub(r"\s+", " ", unicodedata.normalize("NFKC", t or "").lower(), flags=re.A).strip(" ")
        if body:
            digest = hashlib.sha256(body.encode()).hexdigest()
            name = hashlib.md5(f"documents:{i}:{digest}".encode()).digest()
            want[i] = (digest, str(uuid.UUID(bytes=name, version=3)), int(digest[:15], 16))
    got = {r.doc_id: tuple(r)[1:] for r in entry.queries()["q31c_documents"](spark, documents).collect()}
    assert got == want and len(want) == len(TEXTS) - 2


def test_documents_equal_sql(spark, documents):
    """Where the texts hold no compatibility character that SQL is not told about."""
    told = [i for i, t in enumerate(TEXTS) if i not in (4, 5, 8)]  # 5: SQL ends texts at a zero
    for name in ("q31_tokens", "q31c_documents"):
        sql = duck(documents).execute(entry.oracle_sql()[name]).df()
        got = entry.queries()[name](spark, documents).toPandas()
        assert normal(got[got["doc_id"].isin(told)]).equals(normal(sql[sql["doc_id"].isin(told)])) and len(got)
