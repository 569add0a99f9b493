"""Training-data operators on the `documents` table.  Nothing outside this folder imports it."""
