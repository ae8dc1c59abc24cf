"""Knowledge graphs from document collections, as DataFrame plans."""
