"""Where each site keeps its fields, as CSS-style paths.

``path::text`` is the text directly inside the matched elements, ``path ::text`` also
that of everything below, ``path *::text`` only that below, ``path::attr(name)`` an
attribute. A step ``<tag`` goes up to the parent if it is a ``tag``.
"""

from __future__ import annotations

# Detail pages: table -> field -> path.
DETAIL_RULES = {
    "jobs_emploi_senegal": {
        "title": "h1::text",
        "company_name": "div.card-block-company h3 a::text",
        "company_sectors": "div.field-name-field-entreprise-secteur .field-item ::text",
        "description": "div.card-job-description *::text",
        "contract": "li.withicon.file-signature span ::text",
        "region": "li.withicon.location-dot span ::text",
        "education": "li.withicon.graduation-cap span ::text",
        "experience": "li.withicon.chart span ::text",
        "skills": "li.withicon.briefcase span ::text",
        "posted": "time::attr(datetime)",
        "metier_type": "li.withicon.filter-slider span ::text",
        "metiers": "li.withicon.suitcase span ::text",
        "job_missions": "section:nth-of-type(1) div.job-description *::text",
        "job_profile": "section:nth-of-type(2) div.job-qualifications *::text",
        "job_criteria": "section:nth-of-type(3) ul.arrow-list li ::text",
        "job_skills": "section:nth-of-type(3) ul.skills li ::text",
        "job_count": "section:nth-of-type(3) ul.arrow-list li:last-child span ::text",
    },
    "concoursn_stages": {
        "title": "h1.entry-title::text",
        "categories": "span.meta-category a::text",
        "tags": "div.meta-tags a::text",
        "posted_date_raw": "span.updated::text",
        "description": "div.entry-content *::text",
    },
    "emploi_expatdakar": {
        "title": "h1.listing-item__header::text",
        "posted_date": "div.listing-item__details__date::text",
        "ad_id": "div.listing-item__details__ad-id::text",
        "location": "span.listing-item__address-location::text",
        "region": "span.listing-item__address-region::text",
        "property_title": "dt.listing-item__properties__title ::joined",
        "property_value": "dt.listing-item__properties__title +dd::first",
        "description": "div.listing-item__description *::text",
    },
    "senjobs": {
        "cells": "table tr td table tr td td::text",
        "contract_type": "table tr td table tr td strong::text",
        "description": "div.view *::text",
        "categorie": "div.tagcompt::text",
    },
    "emplois": {
        "title": "h1.entry-title::text",
        "location": "li.location a::text",
        "contract_type": "li.job-type::text",
        "posted_date": "li.date-posted time::attr(datetime)",
        "company_name": "div.company_header strong::text",
        "company_logo": "div.company img.company_logo::attr(src)",
        "description_p": "div.job_description p::text",
        "description_ul": "div.job_description ul ::joined",
    },
}

# Property labels of one site -> field.
PROPERTY_LABELS = {
    "Employeur": "employeur",
    "Secteur d'activité": "secteur",
    "Type de contrat": "type_contrat",
    "Niveau d'emploi": "niveau",
    "Niveau d'étude": "niveau_etude",
    "Des années d'expérience": "experience",
    "Nombre de postes": "nb_postes",
}

# Value of the ``source`` column per table.
SOURCE_NAMES = {
    "jobs_emploi_senegal": "Emploi_senegal",
    "concoursn_stages": "concoursn",
    "emploi_expatdakar": "expat-dakar",
    "senjobs": "senjob",
    "emplois": "emploidakar",
}

# Listing pages: block that holds one offer, its link, further fields, link to the next page. Where
# only the number of the page is shown, ``numbered`` is the address of a page up to its number; an optional
# ``last_page`` ends such a listing.
LISTING_RULES = {
    "jobs_emploi_senegal": {
        "block": "div.card-job", "fields": {"link": "h3 a::attr(href)"},
        "next": "li.pager-next a::attr(href)"},
    "concoursn_stages": {
        "block": "article.vce-post", "fields": {"link": "h2.entry-title a::attr(href)"},
        "next": "nav#vce-pagination.vce-load-more a::attr(href)"},
    "emploi_expatdakar": {
        "block": 'a.listing-card__inner[href*="/annonce/"]', "fields": {"link": "::attr(href)"},
        "next": 'a[rel="next"]::attr(href)'},
    "senjobs": {
        "block": "table#offresenjobs tr",
        "fields": {
            "link": "a::attr(href)", "title": "a::text",
            "location": "span.glyphicon.glyphicon-map-marker <span::text",
            "posted_fragments": "span.glyphicon.glyphicon-calendar <span ::text",
            "expiration_fragments": "span.glyphicon.glyphicon-time <span ::text"},
        "next": "div.resultsOffre.activepage span::text", "numbered": "/sn/offres-d-emploi.php?page="},
    "emplois": {
        "block": "li.job_listing", "fields": {"link": "a::attr(href)"}, "next": None},
}
