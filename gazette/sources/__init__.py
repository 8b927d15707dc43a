"""Sources: HTML listings and detail pages, feeds, JSON API bodies, and the
intake steps that normalise them into INTAKE records."""
