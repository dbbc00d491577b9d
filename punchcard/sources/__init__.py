from punchcard.sources.lines import file_lines, literal_lines, read_lines, read_lines_after_first

__all__ = ["file_lines", "literal_lines", "read_lines", "read_lines_after_first"]
