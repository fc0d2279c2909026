"""vaultspan: private-banking analytics expressed as Spark DataFrame plans."""
