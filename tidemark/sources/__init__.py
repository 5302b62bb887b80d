"""Readers of transcripts, captions, speech segments, signals, frames and profiles."""
