"""DataFrame -> DataFrame operators, generic over column names."""
