"""Sources: exports, manifests, record folders, lines of JSON, files, and paged services behind a replaceable client."""
