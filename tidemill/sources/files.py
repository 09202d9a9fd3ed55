"""Small file-system calls: on the driver through Spark's own Hadoop client, inside tasks
through a client of their own with the session's object store settings."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _open(spark, path)
    return fs.exists(jpath)


def create(spark: SparkSession, path: str, text: str = "") -> bool:
    """Create a small file unless it is there; whether this call created it."""
    fs, jpath = _open(spark, path)
    try:
        stream = fs.create(jpath, False)
    except Exception:
        if fs.exists(jpath):
            return False
        raise
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    return True


def read_marker(spark: SparkSession, path: str) -> str:
    fs, jpath = _open(spark, path)
    stream = fs.open(jpath)
    text = bytes(stream.readAllBytes()).decode("utf-8")
    stream.close()
    return text


def children(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """(path, modification time in ms) of what a glob matches; for short listings."""
    fs, jpath = _open(spark, pattern)
    found = fs.globStatus(jpath) or []
    return [(s.getPath().toString(), s.getModificationTime()) for s in found]


def remove(spark: SparkSession, path: str) -> bool:
    fs, jpath = _open(spark, path)
    return fs.delete(jpath, True)


# Settings of the object store client, and their names for the tasks' one.
_STORE_SETTINGS = {
    "fs.s3a.endpoint": "endpoint_override",
    "fs.s3a.access.key": "access_key",
    "fs.s3a.secret.key": "secret_key",
    "fs.s3a.session.token": "session_token",
    "fs.s3a.endpoint.region": "region",
}
_STORES = ("s3", "s3a", "s3n")


def store_options(spark: SparkSession) -> dict[str, str]:
    """The session's own object store settings, for the client that the tasks use."""
    conf = spark._jsc.hadoopConfiguration()
    found = {name: conf.get(key) for key, name in _STORE_SETTINGS.items()}
    return {name: value for name, value in found.items() if value}


def in_reach_of_tasks(path: str) -> bool:
    """Whether the tasks' client knows the kind of store: local folders and S3."""
    scheme, mark, _ = path.partition(":")
    return not mark or scheme in ("file", *_STORES)


def store_of(path: str, options: dict[str, str]):
    """(file system, path inside it, what stands before that path), for use in tasks. The
    path is taken as it is listed."""
    from pyarrow import fs

    scheme, mark, rest = path.partition(":")
    if not mark or scheme == "file":
        return fs.LocalFileSystem(), "/" + (rest if mark else path).lstrip("/"), "file:"
    if scheme in _STORES:
        return fs.S3FileSystem(**options), rest.lstrip("/"), f"{scheme}://"
    host, _, inner = rest.lstrip("/").partition("/")
    return fs.FileSystem.from_uri(f"{scheme}://{host}/")[0], "/" + inner, f"{scheme}://{host}"
