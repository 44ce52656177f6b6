"""Column functions: versions, text, URLs, rubrics."""
