"""The scoring job on a streaming source."""
