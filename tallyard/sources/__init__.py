"""Where rows come from: file drops, table extracts, nested documents, and the test tables."""
