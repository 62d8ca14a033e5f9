"""Bronze, silver and gold layers of the usage pipeline, as batch or streaming transforms."""

from logweir.streaming.layers import bronze_rows, gold_rows, malformed_rows, silver_rows

__all__ = ["bronze_rows", "gold_rows", "malformed_rows", "silver_rows"]
