from .ingest import ingest_extracts

__all__ = ["ingest_extracts"]
