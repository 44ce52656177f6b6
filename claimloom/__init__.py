"""claimloom: evidence analytics over documents and releases as Spark DataFrame plans."""
