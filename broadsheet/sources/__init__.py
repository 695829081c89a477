"""Sources and sinks: archives, thesaurus lines, logs; partitioned tables, chunks, dumps."""
