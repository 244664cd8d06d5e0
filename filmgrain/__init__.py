"""Catalogue analytics (titles, people, genres, roles, ratings) as Spark DataFrame jobs."""
