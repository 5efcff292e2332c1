"""Leafmill: analytics over documents as pages, blocks, lines, tokens and cells, on Spark."""
