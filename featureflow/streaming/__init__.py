from featureflow.streaming.scoring import read_stream, score_stream, start_to_parquet

__all__ = ["read_stream", "score_stream", "start_to_parquet"]
