"""tessera: citation resolution and text analytics expressed as Spark plans."""
