"""Sources: driver tables, the derived raw GTM exports, file readers."""
