"""docquarry: document-corpus analytics expressed as PySpark DataFrame programs."""
