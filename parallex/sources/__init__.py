"""Sources and sinks: corpora, vocabularies on disk, run logs, reports."""
