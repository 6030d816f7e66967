"""quernstone: entity analytics over web pages and documents, expressed as Spark DataFrame plans."""
