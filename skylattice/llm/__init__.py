"""Training-data operators over text, page and vector tables; nothing outside imports this subpackage."""
