"""Word lists, patterns and constants that results depend on, as plain text in their natural order."""

from __future__ import annotations


def _lines(text: str) -> tuple[str, ...]:
    return tuple(x for x in (line.strip() for line in text.splitlines()) if x)


# Parts of a title that mark a category as not semantic.
NOT_SEMANTIC = _lines("""
    _stubs
    Wikipedia_
    Articles_
    Pages_
    Redirects_
    WikiProject_
    User_
    Template_
    All_
    CS1_
    Webarchive_
    Use_dmy_dates
    Use_mdy_dates
    Lists_of_
    List_of_
    _by_country
    _by_continent
    _by_region
    _by_year
    _by_decade
    _by_century
    _by_nationality
    _by_origin
    Individual_
    _in_popular_culture
    _in_fiction
    _in_literature
    _in_film
    _in_television
    _in_art
    _in_music
    _in_video_games
    Fictional_
    Films_about_
    Books_about_
    Songs_about_
    Television_shows_about_
    Video_games_about_
    Comics_about_
    _organizations
    _professionals
    _people
    _companies
    _awards
""")

# The shorter list, for the world-knowledge variant.
NOT_SEMANTIC_SHORT = NOT_SEMANTIC[:13]

# Regular expressions for maintenance categories, searched without regard to case.
MAINTENANCE = _lines(r"""
    ^Articles_
    ^All_articles_
    ^Pages_
    ^All_pages_
    ^Wikipedia_
    ^Wikipedians_
    ^Wikidata_
    ^Commons_
    ^Webarchive_
    ^CS1_
    ^Use_dmy_dates
    ^Use_mdy_dates
    ^Use_American_English
    ^Use_British_English
    ^Use_Indian_English
    ^Use_Canadian_English
    ^Use_Australian_English
    ^Engvar
    ^Short_description
    ^Long_short_description
    ^Good_articles
    ^Featured_articles
    ^Spoken_articles
    ^Cleanup_tagged_articles
    ^Accuracy_disputes
    ^Articles_needing
    ^Articles_lacking
    ^Articles_containing
    ^Articles_to_be
    ^Articles_with
    ^All_stub_articles
    ^Stub_message_templates
    _stubs$
    ^Redirects_
    ^All_redirects
    ^Template_
    ^Templates_
    ^Category_templates
    ^Infobox_templates
    ^Navbox_templates
    ^Sidebar_templates
    ^Portal_
    ^WikiProject_
    ^Project_
    ^Noindexed_pages
    ^Tracked_pages
    ^Dynamic_lists
    ^Incomplete_lists
    ^Pages_using
    ^Pages_with
    ^EngvarB
    ^DISPLAYTITLE
    ^DEFAULTSORT
    ^Hidden_categories
    ^Tracking_categories
    ^Container_categories
    ^Maintenance_categories
    ^Administration_categories
    ^Eponymous_categories
    ^All_articles_from_
    _from_\w+_\d{4}$
    _since_\w+_\d{4}$
    ^Pending_
    ^Proposed_
    ^[A-Z]-Class_
    ^FA-Class_
    ^GA-Class_
    ^B-Class_
    ^C-Class_
    ^Start-Class_
    ^Stub-Class_
    ^Unassessed_
    ^Low-importance_
    ^Mid-importance_
    ^High-importance_
    ^Top-importance_
    ^Unknown-importance_
    ^Taxonbars_
    ^CS1:
    ^All_Wikipedia_
    ^AC_with_
    ^ISNI_
    ^VIAF_
    ^LCCN_
    ^GND_
    ^BNF_
    ^BIBSYS_
    ^IMDb_
    ^MusicBrainz_
    ^Discogs_
    ^SNAC-ID_
    ^Worldcat_
    ^NLA_
    ^SUDOC_
    ^Bot-
    ^Bots_
    ^AWB_
    ^Disputed_
    ^Controversial_
    ^POV_
    ^NPOV_
    ^Orphaned_articles
    ^Dead-end_pages
    _in_translation$
    ^Interlanguage_
    ^Language_articles_
""")

# Titles left out of a ranking by default.
DEFAULT_EXCLUDED = _lines("""
    ISBN
    ISSN
    Digital_object_identifier
    Wayback_Machine
    Wikidata
    PubMed_Central
    PubMed_Identifier
    ArXiv
    Bibcode
    CiteSeerX
    JSTOR
    OCLC
    PMC_(identifier)
    PMID_(identifier)
    S2CID_(identifier)
    Semantic_Scholar
    Handle_System
    LCCN_(identifier)
    VIAF_(identifier)
    WorldCat
    ASCII
    Unicode
    Diacritic
    Ligature_(writing)
    Geographic_coordinate_system
    Taxonomy_(biology)
    Binomial_nomenclature
""")

# The curated list of titles that are infrastructure, not concepts.
CURATED_EXCLUDED = _lines("""
    ISBN
    ISSN
    Digital_object_identifier
    Bibcode
    ArXiv
    PubMed
    PubMed_Central
    PubMed_Identifier
    OCLC
    JSTOR
    CiteSeerX
    Semantic_Scholar
    S2CID
    S2CID_(identifier)
    PMC_(identifier)
    PMID_(identifier)
    Handle_System
    LCCN_(identifier)
    VIAF_(identifier)
    WorldCat
    Zentralblatt_MATH
    Mathematical_Reviews
    ZooBank
    International_Chemical_Identifier
    Unique_Ingredient_Identifier
    Location_identifier
    Wayback_Machine
    Internet_Archive
    Archive.today
    Wikidata
    Wikispecies
    IMDb
    AllMusic
    Discogs
    MusicBrainz
    Rotten_Tomatoes
    Metacritic
    Box_Office_Mojo
    Find_a_Grave
    Goodreads
    Rate_Your_Music
    HanCinema
    British_Newspaper_Archive
    Google_News_Archive
    CricketArchive
    MacTutor_History_of_Mathematics_Archive
    National_Film_and_Sound_Archive
    Library_and_Archives_Canada
    The_National_Archives_(United_Kingdom)
    National_Archives_and_Records_Administration
    20th_Century_Press_Archives
    Global_Biodiversity_Information_Facility
    Open_Tree_of_Life
    Catalogue_of_Life
    Interim_Register_of_Marine_and_Nonmarine_Genera
    INaturalist
    iNaturalist
    Encyclopedia_of_Life
    Integrated_Taxonomic_Information_System
    National_Biodiversity_Network
    Australian_Faunal_Directory
    FloraBase
    Plants_of_the_World_Online
    World_Register_of_Marine_Species
    Tropicos
    IPNI
    The_Plant_List
    GBIF
    ITIS
    NCBI
    National_Center_for_Biotechnology_Information
    BOLD_Systems
    Invasive_Species_Compendium
    IntEnz
    GEOnet_Names_Server
    Taxonomy_(biology)
    Binomial_nomenclature
    Synonym_(taxonomy)
    ASCII
    Diacritic
    Ligature_(writing)
    Greek_alphabet
    HTML_element
    ISO_4
    Daylight_saving_time
    Geographic_coordinate_system
    H:S
    H:L
    H:MW
    H:A
    H:B
    H:C
    H:D
    H:E
    H:F
    H:G
    Dutch_Album_Top_100
    Billboard_Hot_100
    UK_Singles_Chart
    ARIA_Charts
    Oricon
    Gaon_Chart
    Recording_Industry_Association_of_America
    British_Phonographic_Industry
    Race_and_ethnicity_in_the_United_States_census
""")

# Keywords of databases, of citations (detector, finder and recommender differ).
DATABASE_KEYWORDS = tuple("database archive registry catalogue catalog repository identifier biodiversity compendium".split())
CITATION_KEYWORDS = tuple("identifier doi isbn issn pmid arxiv bibcode oclc jstor wayback wikidata pubmed semantic_scholar citeseer handle_system lccn viaf worldcat archive".split())
FINDER_KEYWORDS = tuple("identifier doi isbn issn pmid arxiv bibcode oclc jstor wayback archive wikidata pubmed semantic_scholar citeseer handle_system lccn viaf".split())
RECOMMENDER_KEYWORDS = tuple("identifier _id) isbn issn pmid arxiv wayback_machine wikidata pubmed bibcode".split())
NAMESPACES = tuple("Category: File: Wikipedia: Template: Help: Portal: Draft: Module: MediaWiki: User: Talk:".split())
META_TITLES = {"acronym": r"^[A-Z]{2,6}$", "identifier": r"^_\(identifier\)$", "disambiguation": r"^[A-Z][a-z]+_\(disambiguation\)$"}

# Categories and parts of categories that make a page visual or abstract.
VISUAL_TITLES = tuple(
    "Living_people Animals Plants Fungi Bacteria Mammals Birds Fish Reptiles Amphibians Insects Dogs Cats Horses Buildings_and_structures Vehicles Aircraft Ships Automobiles Furniture Clothing Tools Weapons Machines "
    "Foods Beverages Dishes Cities Countries Mountains Rivers Lakes Islands Landforms Parks Beaches Paintings Sculptures Photographs Films Album_covers Battles Festivals Sports_events Ceremonies".split()
)
ABSTRACT_TITLES = tuple(
    "Mathematical_concepts Philosophical_concepts Abstract_algebra Theorems Conjectures Lemmas Mathematical_axioms Logical_expressions Mathematical_notation Economic_theories Political_theories Legal_concepts "
    "Sociological_theories Psychological_concepts Linguistic_concepts Grammar Syntax Semantics Wikipedia_categories Disambiguation_pages Wikipedia_administration Hidden_categories Tracking_categories Lists Indexes "
    "Outlines Timelines Chronologies Centuries Decades Years Historical_eras Languages Writing_systems Alphabets".split()
)
VISUAL_PARTS = tuple(
    "photographs_of images_of pictures_of _buildings _vehicles _aircraft _ships _people _animals _plants Countries Sovereign_states Member_states_of_the_United_Nations Countries_in_Europe Countries_in_Asia "
    "Countries_in_Africa Oceans Seas Rivers Mountains Deserts _in_europe _in_asia _in_africa _in_north_america member_states_of_ Counting_instruments Mathematical_instruments Writing_implements".split()
)
ABSTRACT_PARTS = tuple("_theory _theories _theorem _theorems _concept _concepts _principles history_of_ timeline_of_ list_of_ index_of_ _languages _language_family".split())

# Scoring of paths in the semantic tree.
ROOT_TITLE = "Main_topic_classifications"
PENALTY = 10
ANCHORS = (
    "Animals", "Plants", "Fungi", "Organisms", "Life", "Nature", "Biology", "Ecology", "Science", "Technology", "Mathematics", "Medicine",
    "Engineering", "Computing", "Computer_science", "People", "Society", "Culture", "History", "Geography", "Places", "Countries", "Nation", "Arts",
    "Music", "Literature", "Philosophy", "Religion", "Education", "Sports", "Games", "Food", "Food_and_drink", "Business", "Economics", "Politics",
    "Law", "Agriculture", "Objects", "Concepts", "Events", "Activities",
)
DOMAIN_ANCHORS = {
    "Animals": ("Animals", "Organisms", "Life", "Biology", "Nature"),
    "Plants": ("Plants", "Organisms", "Life", "Biology", "Nature"),
    "Fungi": ("Fungi", "Organisms", "Life", "Biology", "Nature"),
    "Science": ("Science", "Nature", "Knowledge"),
    "Physics": ("Physics", "Physical_sciences", "Natural_sciences", "Science"),
    "Chemistry": ("Chemistry", "Physical_sciences", "Natural_sciences", "Science"),
    "Biology": ("Biology", "Life_sciences", "Natural_sciences", "Science"),
    "Technology": ("Technology", "Science", "Computing", "Computer_science", "Engineering"),
    "Computing": ("Computing", "Computer_science", "Technology", "Science"),
    "Culture": ("Culture", "Society", "Humanities"),
    "Arts": ("Arts", "Culture", "Humanities"),
    "Society": ("Society", "Culture"),
    "Sports": ("Sports", "Culture", "Activities", "Recreation"),
    "Geography": ("Geography", "Places", "Earth"),
    "Countries": ("Countries", "Geography", "Places", "Nation", "Society"),
    "Food": ("Food", "Food_and_drink", "Plants", "Culture"),
}
DOMAIN_KEYWORDS = (
    ("animal", "Animals"), ("mammal", "Animals"), ("bird", "Animals"), ("fish", "Animals"), ("reptile", "Animals"), ("amphibian", "Animals"),
    ("insect", "Animals"), ("canid", "Animals"), ("feline", "Animals"), ("dog", "Animals"), ("cat", "Animals"), ("horse", "Animals"),
    ("elephant", "Animals"), ("whale", "Animals"), ("dolphin", "Animals"), ("domesticated", "Animals"), ("livestock", "Animals"), ("pet", "Animals"),
    ("vertebrate", "Animals"), ("invertebrate", "Animals"), ("primate", "Animals"), ("rodent", "Animals"), ("carnivore", "Animals"),
    ("plant", "Plants"), ("flower", "Plants"), ("tree", "Plants"), ("flora", "Plants"), ("botan", "Plants"), ("shrub", "Plants"),
    ("vegetables", "Edible_plants"), ("fruit", "Plants"), ("crop", "Plants"), ("herb", "Plants"), ("grass", "Plants"), ("fern", "Plants"),
    ("seed", "Plants"), ("leaf", "Plants"), ("root", "Plants"), ("fung", "Fungi"), ("mushroom", "Fungi"), ("yeast", "Fungi"),
    ("machine_learning", "Technology"), ("comput", "Technology"), ("software", "Technology"), ("hardware", "Technology"),
    ("programming", "Technology"), ("algorithm", "Technology"), ("internet", "Technology"), ("digital", "Technology"), ("robot", "Technology"),
    ("automat", "Technology"), ("cyber", "Technology"), ("neural_network", "Technology"), ("deep_learning", "Technology"),
    ("data_science", "Technology"), ("encryption", "Technology"), ("science", "Science"), ("scientific", "Science"), ("physics", "Physics"),
    ("physical", "Physics"), ("chemi", "Chemistry"), ("biolog", "Biology"), ("genetic", "Biology"), ("quantum", "Physics"), ("mathem", "Science"),
    ("statistic", "Science"), ("countr", "Countries"), ("republic", "Countries"), ("kingdom", "Countries"), ("nation", "Countries"),
    ("federal", "Countries"), ("sovereign", "Countries"), ("territor", "Geography"), ("continent", "Geography"), ("island", "Geography"),
    ("region", "Geography"), ("culture", "Culture"), ("cultural", "Culture"), ("art", "Arts"), ("artist", "Arts"), ("music", "Arts"),
    ("musician", "Arts"), ("literature", "Arts"), ("literary", "Arts"), ("paint", "Arts"), ("sculpt", "Arts"), ("film", "Arts"), ("cinema", "Arts"),
    ("theat", "Arts"), ("drama", "Arts"), ("sport", "Sports"), ("athlet", "Sports"), ("olymp", "Sports"), ("championship", "Sports"),
    ("team", "Sports"), ("player", "Sports"), ("football", "Sports"), ("basketball", "Sports"), ("tennis", "Sports"), ("golf", "Sports"),
    ("food", "Food"), ("cuisine", "Food"), ("dish", "Food"), ("meal", "Food"), ("cook", "Food"), ("recipe", "Food"), ("beverage", "Food"),
    ("drink", "Food"),
)
PENALIZED = _lines("""
    History_of_
    Historical_
    Timeline_of_
    Chronology_of_
    _in_culture
    _in_fiction
    _in_art
    _in_literature
    _in_film
    _in_music
    _in_religion
    _in_mythology
    _in_popular_culture
    _by_country
    _by_continent
    _by_region
    _by_nationality
    _by_ethnicity
    _by_location
    _by_year
    _by_decade
    _by_century
    _by_period
    _terminology
    _concepts
    _stubs
    Wikipedia_
    Articles_
    Pages_
    _and_society
    _and_culture
    _and_politics
    _and_religion
    oidea
    idae
    inae
    iformes
    morpha
    phyta
    mycota
    opsida
    ales
    aceae
    _by_classification
    _by_taxonomy
    Taxonomic_
    Taxa_
    Personhood
    Artificial_objects
    Human_activities
    Human_behavior
    Abstract_
    Abstraction
    _by_type
    _state_types
    Constitutional_
    Places_by_
    Concepts_in_
    Theories_of_
    Philosophy_of_
    Ethnobiology
    Ethno
    Study_of_
""")

# Titles that are never excluded.
PROTECTED = tuple(
    "United_States France Germany United_Kingdom Italy Spain China Japan India Australia Canada Russia Brazil Mexico South_Korea Netherlands Sweden Poland World_War_II World_War_I Animal Plant Human "
    "Association_football Baseball Basketball Cricket Christianity Islam Buddhism Hinduism Judaism Olympic_Games FIFA_World_Cup New_York_City London Paris Tokyo Beijing Berlin Los_Angeles Chicago Sydney Toronto Mumbai "
    "The_New_York_Times BBC CNN Netflix YouTube List_of_sovereign_states".split()
)
