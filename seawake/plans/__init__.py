"""Named reports, views and table definitions built from the operators."""
