from ledgerline.sources.tables import jdbc_reader_options, read_table, save_bucketed, scan_entities, write_append

__all__ = ["jdbc_reader_options", "read_table", "save_bucketed", "scan_entities", "write_append"]
