"""Readers: banner-split text files, EPUB, HTML, JSON payload trees, catalogs, verse corpora."""
