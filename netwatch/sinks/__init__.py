"""Writers: day folders, columnar views, and stores behind a client."""
