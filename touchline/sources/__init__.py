from touchline.sources.files import malformed_csv_rows, read_csv, read_raw, read_staged, write_tables

__all__ = ["malformed_csv_rows", "read_csv", "read_raw", "read_staged", "write_tables"]
