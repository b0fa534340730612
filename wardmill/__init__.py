"""Operations analytics for a clinic star schema, written as Spark DataFrame plans."""
