"""Where results go: writers, tables kept as change batches, change-log files, fan-out."""
