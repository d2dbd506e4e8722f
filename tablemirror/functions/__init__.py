from tablemirror.functions.digest import content_digest, digest_bytes, digest_sum, row_digest

__all__ = ["content_digest", "digest_bytes", "digest_sum", "row_digest"]
