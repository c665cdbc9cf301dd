"""Run-log progress, in batch and as a stream."""
