"""Byte compression of whole batch bodies.

Spark has no compression expressions, so these are UDFs that call the codec once per
body. They are row-batched, not Arrow-batched: Spark hands a worker 100 bodies at a
time, while an Arrow batch holds up to 10,000 rows, and a row here is a whole batch
body, so a worker would hold ever more of them as tables grow. Files are compressed
by Spark's writers instead.
"""

from __future__ import annotations

import gzip

from pyspark.sql import Column, functions as F, types as T

try:
    import zstandard
except ImportError:  # optional
    zstandard = None


def _per_row(function):
    return F.udf(lambda body: None if body is None else function(bytes(body)), T.BinaryType(), useArrow=False)


# A fixed time stamp: the same body gives the same bytes.
_gzip = _per_row(lambda body: gzip.compress(body, mtime=0))
_zstd = _per_row(lambda body: zstandard.ZstdCompressor().compress(body))
_gunzip = _per_row(gzip.decompress)
_unzstd = _per_row(lambda body: zstandard.ZstdDecompressor().decompress(body))


def compress(body: Column, name: str) -> Column:
    """``body`` packed by ``none``, ``gzip`` or ``zstd``."""
    return _apply(body, name, _gzip, _zstd)


def decompress(body: Column, name: str) -> Column:
    return _apply(body, name, _gunzip, _unzstd)


def _apply(body: Column, name: str, gzip_codec, zstd_codec) -> Column:
    if name == "none":
        return body
    if name == "gzip":
        return gzip_codec(body)
    if name == "zstd":
        if zstandard is None:
            raise RuntimeError("zstd needs the zstandard package")
        return zstd_codec(body)
    raise ValueError(f"unsupported compression {name!r}")
