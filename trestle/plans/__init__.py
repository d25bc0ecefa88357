"""Data products (staging -> intermediate -> marts) and the named query registry."""
