"""Jobs: dimensions, the admissions fact, mart writer/reader and the full
star build."""
