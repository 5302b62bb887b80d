"""Timeline operators: DataFrame in, DataFrame out, every one keyed by video_id (or doc_id for notes)."""
