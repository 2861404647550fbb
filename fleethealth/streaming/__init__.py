"""The batch operators on streams, where they have a streaming form. An extension: the batch results remain the reference."""
