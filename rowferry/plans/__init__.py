"""Write plans and whole runs assembled from the operators."""
