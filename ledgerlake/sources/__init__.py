"""Readers: CSV extracts and message envelopes (batch and stream)."""

from .csv_files import read_extract
from .envelopes import (
    ENVELOPE_SCHEMA, indexed_offsets, messages_at, read_envelopes, resume_offsets, starting_offsets, stream_envelopes,
)
from .offset_index import held_stretches, refreshed_index

__all__ = [
    "ENVELOPE_SCHEMA", "held_stretches", "indexed_offsets", "messages_at", "read_envelopes", "read_extract",
    "refreshed_index", "resume_offsets", "starting_offsets", "stream_envelopes",
]
