"""The two parameter sets under which articles are cleaned and chunked."""

from __future__ import annotations

from dataclasses import dataclass

from feedlake import fixed
from feedlake.functions.chunks import ChunkSpec


@dataclass(frozen=True)
class Profile:
    unicode_text: bool  # keep non-ASCII letters
    skip_empty_fields: bool  # an empty body falls through to the summary
    min_chars: int
    min_chars_inclusive: bool
    case_sensitive_hash: bool
    empty_hint_is_unknown: bool
    dedup_per_date: bool  # else the first copy of the whole batch stays
    chunks: ChunkSpec
    min_chunk_chars: int | None


CLUSTER = Profile(
    unicode_text=False,
    skip_empty_fields=False,
    min_chars=fixed.MIN_CONTENT_CHARS,
    min_chars_inclusive=False,
    case_sensitive_hash=False,
    empty_hint_is_unknown=False,
    dedup_per_date=True,
    chunks=ChunkSpec.from_tokens(fixed.CHUNK_TOKENS, fixed.OVERLAP_TOKENS),
    min_chunk_chars=fixed.MIN_CHUNK_CHARS,
)

LOCAL = Profile(
    unicode_text=True,
    skip_empty_fields=True,
    min_chars=fixed.MIN_CONTENT_CHARS,
    min_chars_inclusive=True,
    case_sensitive_hash=True,
    empty_hint_is_unknown=True,
    dedup_per_date=False,
    chunks=ChunkSpec(fixed.LOCAL_CHUNK_WORDS, fixed.LOCAL_OVERLAP_WORDS, keep_blank=False),
    min_chunk_chars=None,
)
